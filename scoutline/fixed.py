"""Texts, word lists, patterns, names and default thresholds that results depend on.

They are part of the data formats and rules, not of this implementation, and are listed as they are.
"""

# Sentinel and labels of creator records.
NOT_FOUND = "Not Found"
PLATFORM = "YouTube"
DEFAULT_SOURCE = "YouTube Data API v3"
PROFILE_URL_PREFIX = "https://www.youtube.com/channel/"
EMAIL_SOURCE = "channel description"
UNFILTERED = "UNFILTERED"
PASS = "PASS"
PASS_NO_EMAIL = "PASS_NO_EMAIL"
FAIL = "FAIL"

# Patterns and character lists of the text rules.
EMAIL_LOCAL = r"[A-Za-z0-9._%+\-]"
EMAIL_DOMAIN = r"[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
EMAIL_TRIM = ".,;:"
PLACEHOLDER_DOMAINS = ("example.com", "domain.com", "email.com")
URL = r"https?://[^\s<>\]\[()]+"
URL_TRIM = ".,;:)"
INSTAGRAM_HOST = "instagram.com"
VIDEO_HOSTS = ("youtube.com", "youtu.be")
APPROVAL_WORDS = ("true", "1", "yes")

# Requests.
RESULT_TYPES = ("channel", "video")
API_PAGE_LIMIT = 50
API_BATCH_LIMIT = 50
KEY_DIGITS = 24
SEARCH_COST = 100
LIST_COST = 1
DAILY_QUOTA = 10_000

# Reasons, in rule order.
REASONS = {
    "followers": "followers outside configured range or unavailable",
    "engagement": "engagement rate below threshold or unavailable",
    "niche": "insufficient fashion/beauty keyword matches",
    "activity": "last upload is older than configured activity window",
    "upload_date": "last upload date unavailable",
    "country": "country does not match configured region",
    "language": "language does not match configured language",
}

# Drafts and failures of the text generator.
PENDING_APPROVAL = "PENDING_APPROVAL"
TRANSIENT_ERRORS = (
    "RateLimitError",
    "APIConnectionError",
    "APITimeoutError",
    "InternalServerError",
)
FATAL_ERRORS = (
    "AuthenticationError",
    "PermissionDeniedError",
    "NotFoundError",
    "BadRequestError",
)
FATAL_STATUS = (400, 401, 402, 403, 404)
ROW_ERROR_STATUS = 400
ROW_ERROR_TEXT = "json_validate_failed"
RATE_LIMITED = 429
SERVER_ERROR = 500

# Contact statuses.
SIMULATED = "SIMULATED"
SENT = "SENT_TO_TEST_INBOX"
FAILED = "FAILED"
DUPLICATE = "SKIPPED_DUPLICATE"
PENDING_MANUAL = "PENDING_MANUAL"

# Default word lists and texts of the settings.
SEARCH_KEYWORDS = (
    "Indian skincare routine",
    "budget skincare India",
    "Indian makeup tutorial",
    "affordable makeup India",
    "Indian fashion haul",
    "budget outfit ideas India",
    "GRWM India",
    "Indian beauty review",
    "hair care routine India",
    "thrift fashion India",
    "small beauty creator India",
    "skincare for Indian skin",
)
NICHE_KEYWORDS = (
    "skincare",
    "makeup",
    "beauty",
    "fashion",
    "outfit",
    "haul",
    "hair",
    "style",
    "cosmetics",
    "grwm",
    "lookbook",
    "thrift",
)
HIGH_ENGAGEMENT_ANGLE = "user-generated content"
MID_ENGAGEMENT_ANGLE = "affiliate partnership"
HIGH_REACH_ANGLE = "paid placement"
DEFAULT_ANGLE = "product seeding"
BRAND_NAME = "YOUR_BRAND"
BRAND_PRODUCT = "YOUR_PRODUCT"
VALUE_PROPOSITION = "Free products plus a paid content partnership"
