"""Word lists, weights, thresholds and column orders.

They are data, not logic.  Every operator takes them as a default argument, so a
caller can pass a different list.
"""

# --- fixed values: columns -------------------------------------------------
EMAIL_COLUMNS = [
    "message_id", "date", "from", "to", "subject", "sender", "list_id",
    "body", "urls", "num_urls", "label",
]
HEADER_FIELDS = ["Message-ID", "Date", "From", "To", "Subject", "Sender", "List-Id"]
REQUIRED_COLUMNS = ["subject", "body", "from", "urls", "label"]
REPUTATION_COLUMNS = [
    "domain", "legitimacy_score", "total_occurrences", "in_spam", "in_ham",
    "sources", "category",
]

# --- fixed values: header names that must not appear in a body ----------------
BODY_HEADER_NAMES = [
    "return-path", "delivered-to", "message-id", "date", "from", "to", "subject",
    "sender", "errors-to", "list-id", "reply-to", "cc", "bcc", "mime-version",
    "content-type", "content-transfer-encoding",
]
BACKFILL_COLUMNS = {
    "message-id": "message_id", "date": "date", "from": "from", "to": "to",
    "subject": "subject", "sender": "sender", "list-id": "list_id",
}

# --- fixed values: keyword stop lists ------------------------------------------
COMMON_WORDS = """
about account agenda business check company contact customer day dear discuss email
hello help information mail meeting message office please project regards schedule
service support team thanks time tomorrow update updates weekly
""".split()
POSITIVE_WORDS = """
approved authentic confirmed genuine honest legitimate official protected reliable
safe secure success trusted valid verified
""".split()
WEAK_SIGNAL_WORDS = """
bring clicking discussing experience going imagine moved needed review status verify
want wanted would
""".split()

# --- fixed values: keyword and phrase weights ----------------------------------
KEYWORD_WEIGHTS = {
    "accept": 3, "access": 6, "adult": 18, "bank": 8, "bonus": 7, "cash": 7,
    "chat": 10, "claim": 8, "click": 5, "confirm": 7, "credentials": 10, "dating": 8,
    "date": 2, "disclaimer": 2, "exclusive": 8, "free": 6, "fun": 1, "gift": 7,
    "immediately": 4, "invoice": 6, "limited": 6, "login": 10, "moments": 1,
    "offer": 6, "otp": 8, "password": 10, "payment": 7, "photos": 8, "prize": 8,
    "private": 8, "reset": 8, "security": 7, "special": 2, "suspended": 10,
    "tonight": 2, "urgent": 8, "verify": 9, "wallet": 8, "website": 2, "winner": 8,
}
PHRASE_WEIGHTS = {
    "access your account": 18, "adult chat": 28, "click here": 12,
    "confirm your account": 18, "exclusive photos": 24, "limited time": 12,
    "password reset": 24, "private chat": 24, "reset your password": 28,
    "special moments": 14, "suspended account": 18, "urgent action": 16,
    "verify your account": 22,
}
ADULT_CLUSTER = ["adult", "chat", "private", "exclusive", "photos", "dating"]
PHISHING_CLUSTER = [
    "access", "bank", "claim", "click", "confirm", "credentials", "login", "otp",
    "password", "payment", "reset", "security", "suspended", "urgent", "verify",
    "wallet",
]
HIGHLIGHT_OPEN = (
    '<span style="background-color: #28a745; font-weight: bold; '
    'color: white; padding: 2px 4px; border-radius: 3px;">'
)
HIGHLIGHT_CLOSE = "</span>"

# --- fixed values: links and domains ----------------------------------------------
RISKY_BRAND_MODIFIERS = """
account auth billing bonus check claim confirm gift invoice limited logon login pay
payment portal prize recover reset secure security signin support update verify wallet
web
""".split()
KNOWN_LEGIT_DOMAINS = [
    "sourceforge.net", "linux.ie", "slashnull.org", "github.com", "microsoft.com",
    "google.com", "apache.org", "kernel.org", "gnu.org", "debian.org", "ubuntu.com",
    "redhat.com",
]
SPAM_DOMAIN_MARKS = [
    "geocities.com", "mailexcite.com", "hotmail.com", "aol.com", "free", "promo", "deal",
]
SECOND_LEVEL_LABELS = ["co", "com", "org", "net", "gov", "edu"]
SECOND_LEVEL_COUNTRIES = ["uk", "au", "nz", "jp", "in"]
DEFAULT_SUFFIXES = """
com org net edu gov io info me biz dev app ru ie de fr es it nl eu ca ch se no
uk co.uk ac.uk org.uk gov.uk au com.au org.au edu.au jp co.jp ac.jp in co.in
nz co.nz sg com.sg edu.sg br com.br cn com.cn za co.za
""".split()

# --- fixed values: text features ----------------------------------------------------
PLACEHOLDER_VALUES = ["nan", "none", "null", "n/a", "<na>"]
GENERIC_TOKENS = ["subject", "body", "sender", "urls", "combined"]
FREE_MAIL_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "live.com", "aol.com",
    "icloud.com", "msn.com", "proton.me", "protonmail.com",
]
URGENCY_TERMS = [
    "urgent", "immediately", "asap", "today", "now", "alert", "limited", "deadline",
    "expiring",
]
ACCOUNT_TERMS = [
    "verify", "login", "log in", "password", "reset", "update", "confirm", "security",
    "account", "suspended",
]
OFFER_TERMS = ["free", "gift", "bonus", "prize", "winner", "deal", "discount", "promotion"]
NUMERIC_FEATURES = {
    "subject_length": "Subject length added some phishing signal",
    "body_length": "Body length added some phishing signal",
    "url_count": "Email contains several links",
    "sender_domain_depth": "Sender domain depth looks unusual",
    "uppercase_token_count": "Email uses many uppercase words",
    "exclamation_count": "Email uses many exclamation marks",
    "digit_ratio": "Email has an unusually high digit ratio",
    "currency_symbol_count": "Email mentions money or currency symbols",
    "urgency_term_count": "Email uses urgent language",
    "account_term_count": "Email pushes account or login actions",
    "offer_term_count": "Email uses offer or giveaway language",
    "sender_is_free_mail": "Sender uses a free-mail domain",
    "ip_url_count": "Email includes an IP-based link",
    "hyphenated_url_count": "Email includes highly hyphenated links",
    "link_token_count": "Email repeats link-like text patterns",
}
NUMERIC_COLUMNS = list(NUMERIC_FEATURES)

# --- fixed values: model and risk thresholds --------------------------------------
MODEL_NAME = "hybrid_text_numeric_logistic_regression"
MODEL_THRESHOLD = 0.42
SUBJECT_TERMS, BODY_TERMS, CHAR_TERMS = 5000, 11000, 9000
MIN_DOC_FREQ = 2
REGULARISATION_C = 6.0
MAX_ITERATIONS = 3000
SOLVER_TOLERANCE = 3e-5  # of the loss; every slope is then below GRADIENT_TOLERANCE
GRADIENT_TOLERANCE = 1e-3
RISKY_CATEGORIES = ["spam", "suspicious"]
WATCH_CATEGORIES = ["uncertain", "not found", "unknown"]

# English stop words of Spark ML.
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how all any both each few more most
    other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll
    she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
    who's why's would
""".split()
