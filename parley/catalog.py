"""Fixed values that must equal the product's own constants.

Kept together, in natural order, as plain text.
"""

# --- fixed values: defaults of the stores -------------------------------
DEFAULT_MODEL = "gpt-3.5-turbo"
DEFAULT_PROVIDER = "email"
DEFAULT_TIER = "free"
DEFAULT_TITLE = "New Conversation"
TITLE_MAX = 50          # longer titles are cut ...
TITLE_KEEP = 47         # ... to this many characters plus "..."
TITLE_ELLIPSIS = "..."

# --- fixed values: enumerations ------------------------------------------
AUTH_PROVIDERS = ["email", "google", "apple"]
SUBSCRIPTION_TIERS = ["free", "premium", "enterprise"]
MESSAGE_ROLES = ["user", "assistant", "system"]

# --- fixed values: model catalogue (listed models, in listing order) -----
AVAILABLE_MODELS = [
    "gpt-4",
    "gpt-3.5-turbo",
    "claude-3-sonnet",
    "claude-3-haiku",
    "mistral-7b-instruct",
    "mistral-medium",
]
PREMIUM_MODELS = ["gpt-4"]

# --- fixed values: provider routing, first match wins --------------------
# (substring of the model name, provider label); no match routes to "openai"
# with the default model.
PROVIDER_ROUTES = [
    ("gpt", "openai"),
    ("claude", "anthropic"),
    ("mistral", "mistral"),
]
FALLBACK_PROVIDER = "openai"

# --- fixed values: reply texts that mark a response outcome --------------
OUTCOME_TEXTS = [
    ("I apologize, but I encountered an error processing your request. Please try again.", "error"),
    ("OpenAI is not configured. Please check your API key.", "unconfigured"),
    ("Claude integration is not yet implemented. This is a mock response from Claude.", "mock"),
    ("Mistral AI integration is not yet implemented. This is a mock response from Mistral.", "mock"),
    ("No response generated.", "empty"),
]
OUTCOME_OK = "ok"

# --- fixed values: limits -------------------------------------------------
RATE_LIMIT = 100                 # requests ...
RATE_WINDOW = "1 minute"         # ... per window per client
TOKEN_TTL_SECONDS = 7 * 86400    # signed tokens live 7 days
LATENCY_TARGET_MS = 200.0
PAGE_DEFAULT = 1
PAGE_LIMIT_DEFAULT = 20
PAGE_LIMIT_MAX = 100

# --- fixed values: validation bounds --------------------------------------
NAME_MIN, NAME_MAX = 2, 50
PASSWORD_MIN, PASSWORD_MAX = 6, 100
LOGIN_PASSWORD_MIN = 6
