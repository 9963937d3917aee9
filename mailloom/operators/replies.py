"""Reply selection, classification and what follows from it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BOUNCE_CLASS, CLASS_SLUGS, FOLLOW_UP_ACTIONS, REPLY_RULES, SUPPRESSING_CLASSES, UNKNOWN_CLASS,
)
from ..functions.emails import is_valid_email, normalize_email
from ..functions.text import any_of, contains_any, let, literal_map, regex_quote

Rules = Sequence[tuple[str, Sequence[str]]]

def rule_pattern(keywords: Iterable[str]) -> str:
    """Whole-word pattern of a rule; only ASCII characters count as word characters."""
    words = [k.lower() for k in keywords if k]
    return f"(?<![A-Za-z0-9_]){any_of(words)}(?![A-Za-z0-9_])" if words else "(?!)"


def message_text(subject: Column, body: Column) -> Column:
    """Lower-cased subject and body, joined by a blank; NULL counts as ''."""
    return F.lower(F.concat(F.coalesce(subject, F.lit("")), F.lit(" "),
                            F.coalesce(body, F.lit(""))))


def _first_keyword_pattern(rules: Rules) -> str:
    """Group 1 is, at each word start, the keyword of the best rule that matches there.

    Keywords are tried in rule order; grouping them by first character keeps
    that order among those that can match at the same place.
    """
    groups: dict[str, list[str]] = {}
    for _, keywords in rules:
        for word in map(str.lower, keywords):
            if word:
                groups.setdefault(word[0], []).append(word[1:])
    words = "|".join(regex_quote(c) + any_of(rest) for c, rest in groups.items())
    return f"(?<![A-Za-z0-9_])(?=({words})(?![A-Za-z0-9_]))"


def reply_class(text: Column, rules: Rules = REPLY_RULES, status: Column | None = None) -> Column:
    """Class of a lower-cased message: first matching rule, else Unknown.

    One pass over the text finds the best keyword at every word start; the
    best rule among them decides.  A delivery status of 'Bounced' comes before
    any keyword.
    """
    rank: dict[str, str] = {}
    for i, (_, keywords) in enumerate(rules):
        for word in map(str.lower, keywords):
            if word:
                rank.setdefault(word, str(i))
    if rank:
        ranks = literal_map(rank)
        found = F.regexp_extract_all(text, F.lit(_first_keyword_pattern(rules)), F.lit(1))
        best = F.array_min(F.transform(found, lambda w: F.element_at(ranks, w).cast("int")))
        names = F.array(*[F.lit(name) for name, _ in rules])
        by_text = F.coalesce(F.get(names, best), F.lit(UNKNOWN_CLASS))
    else:
        by_text = F.lit(UNKNOWN_CLASS)
    if status is None:
        return by_text
    return F.when(status == "Bounced", F.lit(BOUNCE_CLASS)).otherwise(by_text)


def classify_replies(msgs: DataFrame, rules: Rules = REPLY_RULES, subject: str = "subject",
                     body: str = "body", status: str | None = None) -> DataFrame:
    """Add ``classification``; all other columns pass through."""
    text = message_text(F.col(subject), F.col(body))
    state = F.col(status) if status else None
    return msgs.withColumn("classification", reply_class(text, rules, state))


def matched_classes(msgs: DataFrame, rules: Rules = REPLY_RULES, subject: str = "subject",
                    body: str = "body") -> DataFrame:
    """Add ``matches``: every matching class with its first matching keyword."""
    text = message_text(F.col(subject), F.col(body))
    hits = F.array(*[
        F.struct(F.lit(name).alias("classification"),
                 F.regexp_extract(text, rule_pattern(words), 0).alias("keyword"))
        for name, words in rules
    ])
    return msgs.withColumn("matches", F.filter(hits, lambda h: h["keyword"] != ""))


_WORD = "[A-Za-z0-9_]+"


def _words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(_WORD), F.lit(0))


def _gaps(c: Column) -> Column:
    """What stands before, between and after the words: one more than there are words."""
    return F.split(c, _WORD, -1)


def _stands_at(text: Column, rule: Column) -> Column:
    """Whether a keyword stands in a text (words, gaps) from the word ``rule.at`` on, as whole words.

    Next to a gap of its own at either end a keyword needs another character or the end of the text.
    """
    n, at = F.size(rule["words"]), rule["at"]
    before, after = F.get(text["gaps"], at), F.get(text["gaps"], at + n)
    first, last = F.get(rule["gaps"], F.lit(0)), F.get(rule["gaps"], n)
    inner = lambda gaps, start: F.slice(gaps, start, n - 1)
    return (
        (at >= 0) & (at + n <= F.size(text["words"])) & (F.slice(text["words"], F.greatest(at, F.lit(0)) + 1, n) == rule["words"])
        & (inner(text["gaps"], F.greatest(at, F.lit(0)) + 2) == inner(rule["gaps"], F.lit(2)))
        & F.endswith(before, first) & ((first == "") | (at == 0) | (F.length(before) > F.length(first)))
        & F.startswith(after, last) & ((last == "") | (at + n == F.size(text["words"])) | (F.length(after) > F.length(last))))


def _signs(c: Column) -> Column:
    """The distinct characters that belong to no word."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(c, _WORD, ""), "", -1), lambda x: x != ""))


def filed_keywords(rules: DataFrame, places: DataFrame) -> DataFrame:
    """Rules (priority, classification, keyword) with the token each is filed under, and its place in the keyword.

    That is the word of the keyword that is rarest in ``places`` (id, token, place);
    for a keyword without words, the rarest of its characters.
    """
    table = rules.select("priority", "classification", F.lower("keyword").alias("keyword")).where(
        F.coalesce(F.col("keyword"), F.lit("")) != "").distinct()
    words = _words(F.col("keyword"))
    tokens = table.select("*", words.alias("words"), _gaps(F.col("keyword")).alias("gaps"), F.posexplode(
        F.when(F.size(words) > 0, words).otherwise(_signs(F.col("keyword")))).alias("place", "token"))
    seen = places.join(tokens.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
    return tokens.join(seen, "token", "left").groupBy("priority", "classification", "keyword").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "token")).alias("filed"),
        F.first("words").alias("words"), F.first("gaps").alias("gaps")).select(
        "priority", "classification", "keyword", "words", "gaps", "filed.token", F.col("filed.place").alias("offset"))


def classify_with_table(msgs: DataFrame, rules: DataFrame, subject: str = "subject",
                        body: str = "body", status: str | None = None) -> DataFrame:
    """As :func:`classify_replies` with rules (priority, classification, keyword) from a table of any size.

    The smallest priority wins, then the smallest class name.  Keywords are
    lower-cased; empty ones are left out.  Each distinct text is classified once.

    A keyword is filed under its rarest word, so a word that many keywords and
    messages share brings nothing together.  Only (text id, word, place) meets the
    rules; the texts come back once, and each compares its words with the keywords found.
    """
    keyed = msgs.withColumn("_text", message_text(F.col(subject), F.col(body))).withColumn("_text_id", F.md5("_text"))
    texts = keyed.select("_text_id", "_text").dropDuplicates(["_text_id"])
    places = texts.select("_text_id", F.posexplode(_words(F.col("_text"))).alias("place", "token")).unionByName(
        texts.select("_text_id", F.lit(-1).alias("place"), F.explode(_signs(F.col("_text"))).alias("token")))
    filed = filed_keywords(rules, places)
    met = places.join(filed, "token").select("_text_id", F.struct(
        "priority", "classification", "keyword", "words", "gaps", (F.col("place") - F.col("offset")).alias("at")).alias("rule"))
    found = met.groupBy("_text_id").agg(F.collect_set("rule").alias("_rules"))
    quoted = lambda k: F.concat(F.lit("(?<![A-Za-z0-9_])"), F.regexp_replace(k, r"([^A-Za-z0-9_\s])", r"\\$1"),
                                F.lit("(?![A-Za-z0-9_])"))

    def best(text: Column) -> Column:
        fit = F.filter("_rules", lambda r: F.when(F.size(r["words"]) > 0, _stands_at(text, r)).otherwise(
            F.rlike(text["text"], quoted(r["keyword"]))))
        return F.array_min(F.transform(fit, lambda r: F.struct(
            r["priority"].alias("priority"), r["classification"].alias("classification"))))

    parts = F.struct(F.col("_text").alias("text"), _words(F.col("_text")).alias("words"), _gaps(F.col("_text")).alias("gaps"))
    classes = texts.join(found, "_text_id").select("_text_id", let(parts, best).alias("_best")).select(
        "_text_id", F.col("_best").getField("classification").alias("_class"))
    out = F.coalesce("_class", F.lit(UNKNOWN_CLASS))
    if status is not None:
        out = F.when(F.col(status) == "Bounced", F.lit(BOUNCE_CLASS)).otherwise(out)
    return keyed.join(classes, "_text_id", "left").select(*msgs.columns, out.alias("classification"))


def class_slug(classification: Column) -> Column:
    """Folder name of a class; custom classes get a plain lower-case form."""
    plain = F.regexp_replace(F.lower(classification), "[^a-z0-9]+", "_")
    return F.coalesce(F.element_at(literal_map(CLASS_SLUGS), classification), plain)


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("classification").agg(F.count(F.lit(1)).alias("n_replies"))


def follow_up_actions(classified: DataFrame) -> DataFrame:
    """Add the next ``action`` and whether the contact must not be mailed again."""
    return classified.withColumn(
        "action", F.element_at(literal_map(FOLLOW_UP_ACTIONS), F.col("classification"))
    ).withColumn("suppress", F.col("classification").isin(list(SUPPRESSING_CLASSES)))


def select_replies(inbox: DataFrame, recipients: DataFrame, keywords: Sequence[str],
                   self_email: str) -> DataFrame:
    """Messages from known recipients about the campaign, own messages left out."""
    sender = normalize_email(F.col("from_email"))
    wanted = inbox.withColumn("email", sender).where(
        (F.col("email") != self_email.strip().lower())
        & contains_any(F.lower("subject"), [k.lower() for k in keywords]))
    known = recipients.select(normalize_email(F.col("email")).alias("email"))
    return wanted.join(known, "email", "left_semi")


def unique_recipients(recipients: DataFrame) -> DataFrame:
    """One row per normalised address; the smallest row wins among duplicates."""
    others = [c for c in recipients.columns if c != "email"]
    keyed = recipients.withColumn("email", normalize_email(F.col("email"))).where(
        is_valid_email(F.col("email")))
    if not others:
        return keyed.distinct()
    return keyed.groupBy("email").agg(F.min(F.struct(*others)).alias("r")).select("email", "r.*")


def enrich_replies(replies: DataFrame, recipients: DataFrame,
                   columns: Sequence[str] = ("name", "university")) -> DataFrame:
    """Add recipient columns to replies by address."""
    known = unique_recipients(recipients.select("email", *columns))
    return replies.join(known, "email", "left")


def suppression_list(classified: DataFrame | None = None, status: DataFrame | None = None,
                     unsubscribed: DataFrame | None = None) -> DataFrame:
    """(email, reason) of everyone who must not be mailed again, one row each.

    ``classified`` replies (email, classification), delivery ``status``
    (email, status) and valid ``unsubscribed`` requests (email) all count;
    an unsubscribe outranks a bounce.
    """
    parts = []
    if classified is not None:
        parts.append(classified.where(F.col("classification").isin(list(SUPPRESSING_CLASSES)))
                     .select("email", F.when(F.col("classification") == BOUNCE_CLASS, "bounce")
                             .otherwise("unsubscribe").alias("reason")))
    if status is not None:
        parts.append(status.where(F.col("status").isin("Bounced", "Unsubscribed")).select(
            "email", F.when(F.col("status") == "Bounced", "bounce")
            .otherwise("unsubscribe").alias("reason")))
    if unsubscribed is not None:
        parts.append(unsubscribed.select("email", F.lit("unsubscribe").alias("reason")))
    if not parts:
        raise ValueError("no source of suppressions given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # 'unsubscribe' sorts after 'bounce', so max() keeps it.
    return out.groupBy(normalize_email(F.col("email")).alias("email")).agg(
        F.max("reason").alias("reason"))


def suppress(recipients: DataFrame, suppressions: DataFrame) -> DataFrame:
    """Recipients that may still be mailed."""
    blocked = suppressions.select(normalize_email(F.col("email")).alias("_blocked"))
    return recipients.join(
        blocked, normalize_email(F.col("email")) == F.col("_blocked"), "left_anti")


def validate_unsubscribes(requests: DataFrame, tokens: DataFrame) -> DataFrame:
    """First request per issued token, with its address."""
    first = requests.groupBy("token").agg(F.min("ts").alias("ts"))
    return first.join(tokens.select("token", "email").distinct(), "token")


def rejected_unsubscribes(requests: DataFrame, tokens: DataFrame) -> DataFrame:
    """Requests whose token was never issued."""
    return requests.join(tokens.select("token"), "token", "left_anti")


