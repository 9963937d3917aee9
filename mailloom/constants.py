"""Default word lists and limits.

These are fixed values: results only agree with the documented behaviour when
they are used exactly as written.  Every operator takes them as parameters, so
callers can pass their own lists.
"""

from __future__ import annotations

# Address suffixes that are kept by default.
DEFAULT_SUFFIXES = (".dz",)

# Substrings of the local part that mark a role (non-personal) address.
ROLE_PATTERNS = (
    "noreply", "no-reply", "donotreply", "contact", "info", "support", "help",
    "webmaster", "admin", "administrator", "postmaster", "abuse", "security",
    "service", "services", "assistance", "secretariat", "secretary",
    "secretaire", "direction", "directeur", "director", "rectorat", "rector",
    "recteur", "communication", "com", "marketing", "presse", "media",
    "relations", "accueil", "reception", "welcome", "inscription", "admission",
    "registration", "biblio", "bibliotheque", "library", "technique",
    "technical", "tech", "system", "systems", "sysadmin", "test", "testing",
    "demo", "mail", "email", "courrier", "generic", "default", "example",
    "elearning", "e-learning", "elearn", "authentification", "auth",
    "authentication", "vrp", "vrex", "vr-relex", "vr-", "vr.pedagogie",
    "vr.relex", "vr.equip", "vr.recherche", "doyen", "doyen.", "doyen.ecg",
    "doyen.dsp", "doyen.sci", "doyen.tec", "doyen.seg", "doyen.ssh",
    "doyen.lla", "cei", "ceil", "ciav", "cri", "ufc", "lsp", "laa", "aih",
    "xxx.xxx", "xxx", "univ-mcd", "univ.",
)

# Prefixes of the local part that only the strict role test rejects.
ROLE_PREFIXES = (
    "vr.", "doyen.", "chef.", "directeur.", "director.", "admin.", "service.",
)

# Reply classes and their keywords, in matching order (first match wins).
REPLY_RULES = (
    ("Potential Buyers", ("buy", "purchase", "order", "price", "cost", "pricing", "quote",
                          "interested in buying", "ready to buy", "want to buy")),
    ("Demo Scheduled", ("demo", "schedule", "meeting", "call", "zoom", "teams", "calendar",
                        "appointment", "available", "time slot")),
    ("Leads", ("interested", "tell me more", "more information", "info", "details", "how does",
               "what is", "questions", "curious", "learn more")),
    ("More Information", ("more info", "more details", "specifications", "specs", "features",
                          "benefits", "how it works")),
    ("Price Objection", ("expensive", "too much", "cost", "budget", "afford", "cheaper",
                         "discount", "deal")),
    ("Not Right Time", ("not now", "later", "next month", "next year", "busy", "timing",
                        "not the right time", "future")),
    ("Follow-up Needed", ("think about", "consider", "discuss", "team", "manager", "decision",
                          "review", "evaluate")),
    ("Not Interested", ("not interested", "no thanks", "decline", "pass", "not for us",
                        "don't need")),
    ("Wrong Person", ("wrong person", "not me", "not the right", "different department",
                      "forwarded")),
    ("Out of Office", ("out of office", "ooo", "away", "vacation", "unavailable", "auto-reply",
                       "automatic reply")),
    ("Unsubscribe", ("unsubscribe", "remove", "stop", "opt out", "don't email",
                     "no more emails")),
    ("Customer", ("purchased", "bought", "customer", "already have", "using", "implemented")),
)
UNKNOWN_CLASS = "Unknown"
BOUNCE_CLASS = "Bounce"

# Output folder name of each reply class.
CLASS_SLUGS = {
    "Potential Buyers": "potential_buyers",
    "Demo Scheduled": "demo_scheduled",
    "Leads": "leads",
    "More Information": "more_information",
    "Price Objection": "price_objection",
    "Not Right Time": "not_right_time",
    "Follow-up Needed": "follow_up_needed",
    "Not Interested": "not_interested",
    "Wrong Person": "wrong_person",
    "Out of Office": "out_of_office",
    "Unsubscribe": "unsubscribes",
    "Customer": "customers",
    "Bounce": "bounces",
    "Unknown": "unknown",
}

# What to do next with a contact of each reply class.
FOLLOW_UP_ACTIONS = {
    "Potential Buyers": "send_quote",
    "Demo Scheduled": "confirm_demo",
    "Leads": "send_information",
    "More Information": "send_documents",
    "Price Objection": "discuss_price",
    "Not Right Time": "contact_later",
    "Follow-up Needed": "help_decide",
    "Not Interested": "close",
    "Wrong Person": "ask_for_contact",
    "Out of Office": "wait_for_return",
    "Unsubscribe": "remove",
    "Customer": "hand_over",
    "Bounce": "mark_invalid",
    "Unknown": "review",
}

# Reply classes that stop all further sends to the contact.
SUPPRESSING_CLASSES = ("Unsubscribe", "Bounce")

# Substrings of a lower-cased URL or href that mark a login or admin page.
SKIP_URL_PARTS = ("/user?", "/login", "/admin", "admin_panel", "?login=", "&login=")

# Link texts that mark a pagination link.
PAGINATION_TEXTS = ("next", "suivant", "»", "last", "dernier", "precedent", "previous", "«")

# URL parts that rule out a personal page ("firstname-lastname").
PERSON_PAGE_EXCLUDES = ("websites", "contact", "page", "admin")
PERSON_LINK_EXCLUDES = ("websites", "contact", "page", "admin", "login")

# Keywords of links found in page text.
PRIORITY_KEYWORDS = (
    "staff", "websites", "contact", "personnel", "enseignants", "professeurs",
    "equipe", "team", "annuaire", "directory", "faculte", "faculty",
    "departement", "department", "corps", "enseignant", "professeur",
    "chercheur", "researcher",
)
# Keywords of anchors: the list above and two more.
STAFF_KEYWORDS = PRIORITY_KEYWORDS + ("teacher", "teachers")

# Keywords of faculty and department links.
FACULTY_KEYWORDS = (
    "faculte", "faculty", "facultes", "faculties", "departement", "department",
    "departements", "departments", "filiere", "specialite", "speciality",
    "formation", "domaine", "domain", "section", "option", "mathematiques",
    "mathematics", "math", "fmath", "informatique", "computer", "info", "cs",
    "physique", "physics", "phys", "chimie", "chemistry", "chim", "biologie",
    "biology", "bio", "electronique", "electronics", "elec", "mecanique",
    "mechanical", "meca", "genie", "engineering", "civil", "archi", "economie",
    "economics", "eco", "droit", "law", "juridique", "lettres", "literature",
    "langues", "philosophie", "philosophy", "philo", "sociologie", "sociology",
    "socio", "psychologie", "psychology", "psy", "medecine", "medicine", "med",
    "pharmacie", "pharmacy", "pharma", "sciences", "sci", "islamiques",
    "islamic", "fsi",
)

# The shorter lists used when a link is ranked by its URL alone.
FRONTIER_FACULTY_KEYWORDS = (
    "faculte", "faculty", "facultes", "faculties", "departement", "department",
    "departements", "departments", "filiere", "specialite", "formation",
    "domaine", "section", "option", "mathematiques", "informatique",
    "physique", "chimie", "biologie", "electronique", "mecanique", "genie",
    "economie", "droit", "lettres", "philosophie", "sociologie",
    "psychologie", "medecine", "pharmacie", "sciences", "islamiques", "fsi",
)
FRONTIER_PRIORITY_KEYWORDS = (
    "staff", "websites", "contact", "personnel", "enseignants", "professeurs",
    "annuaire", "directory",
)

# Prefixes tried as department subdomains of a seed.
SUBDOMAIN_PREFIXES = (
    "fmath", "math", "info", "informatique", "phys", "chim", "bio", "fbiol",
    "elec", "meca", "civil", "archi", "eco", "droit", "lettres", "philo",
    "socio", "psy",
)

# Free-tier limits of mail providers: (provider, per_day, per_month, per_second).
PROVIDER_LIMITS = (
    ("sendgrid", 100, None, 100),
    ("mailjet", 200, 6000, None),
    ("mailgun", None, 5000, None),
    ("ses", 200, None, 1),
    ("sendgrid-essentials", None, 40000, 100),
)

DEFAULT_CRAWL_DELAY = 2.0
# Limits of a walk for callers that want them; none is on by default.
MAX_PAGES_PER_SEED = 2000
LINKS_PER_LEVEL = 500
QUEUE_FACTOR = 5
RENDER_HTML_LENGTH = 10000
TITLE_LENGTH = 200
SNIPPET_LENGTH = 200
TEXT_CONTEXT = 100
SCRIPT_CONTEXT = 50
BATCH_SIZE = 10
BATCH_WAIT_SECONDS = 60
PILOT_SIZE = 50
