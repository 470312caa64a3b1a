"""Fixed values that results depend on, and defaults."""

# Output fields that say nothing about a domain.
GENERIC_FIELDS = (
    "id", "status", "message", "results", "data", "page", "limit", "offset", "error", "code", "url", "text", "value", "key",
    "format", "title", "label", "description", "name", "type", "result", "success", "total", "total_count", "count",
    "errors", "response", "output",
)

# Infrastructure fields of responses.
INFRA_FIELDS = (
    "get", "parameters", "errors", "response", "object", "created", "usage", "choices", "model", "version", "haserror", "statuscode",
    "statusmessage", "responsecode", "responsemessage", "paymentmethods", "item_name", "item_id", "created_at", "updated_at",
    "callback", "next", "previous", "per_page", "page_size", "sort", "order", "order_by",
)

# Names of tools that are tests, demos or placeholders.
JUNK_NAMES = (
    r"^test", r"demo", r"petstore", r"onboarding", r"^sample", r"^my\s*(api|store)", r"^a{3,}$", r"^[a-z]{1,4}$", r"^\d+$", r"asdf",
    r"should\s*be\s*free", r"hard\s*limit", r"rate\s*limit", r"blitz$", r"testing\s*inbox", r"^erictestpet", r"^platformbil", r"^urltest",
    r"^team\s+petstore", r"^teste$", r"^flow\s+study", r"^colegiosantaana", r"multipleteams", r"privatepublic", r"freeplanhardlimit", r"^pe-",
)

# Spellings of types.
TYPE_NAMES = {
    "string": "string", "str": "string", "text": "string", "int": "integer", "integer": "integer", "number": "number", "float": "number",
    "double": "number", "boolean": "boolean", "bool": "boolean", "object": "object", "dict": "object", "array": "array", "list": "array",
}
METHODS = ("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS")

# Suffixes that a field's root lacks.
ROOT_SUFFIXES = ("id", "identifier", "code", "key", "number", "token", "date", "time", "name", "type", "url", "uri", "link")

# Credential parameters (whole tokens, and parts of a name).
AUTH_TOKENS = (
    "token", "secret", "password", "credential", "credentials", "apikey", "api_key", "access_token", "auth", "authorization",
    "client_secret", "client_id", "app_key", "app_secret", "app_id", "bearer",
)
AUTH_PARTS = ("token", "secret", "password", "credential")

# The broader test that scenarios use.
SCENARIO_AUTH = ("key", "token", "auth", "secret", "password", "credential", "apikey", "api_key", "app_id", "app_key", "access_token")
SCENARIO_INFRA = (
    "locale", "lang", "language", "units", "format", "order_by", "sort", "sort_by", "filter_by", "callback", "page", "limit",
    "offset", "per_page", "page_size", "include", "exclude", "fields", "response_format",
)

# Endpoint names that search and that act.
SEARCH_WORDS = ("search", "find", "list", "get_all", "query", "browse")
ACTION_WORDS = ("book", "create", "register", "order", "add", "reserve", "update", "delete")
ID_PARTS = ("_id", "id", "_code", "_key", "_token")

# Edge confidence.
NAME_WEIGHT, TYPE_WEIGHT, CATEGORY_WEIGHT, SPECIFICITY_WEIGHT = 0.20, 0.10, 0.30, 0.40
HARD, SOFT, GENERIC_FRACTION = 0.7, 0.6, 0.005

# Gates of an evaluation.
GATES = (("naturalness", 4.0), ("tool_correctness", 3.0), ("task_completion", 3.5), ("overall_mean", 3.6), ("ms_mt_rate", 0.5))
