"""Values fixed by the data contract: they show up in results and must not drift."""

# Size limit, in UTF-8 bytes, of an indexed string or blob.
INDEXED_BYTES_LIMIT = 1500

# Text spellings of booleans (compared after trimming and lower-casing).
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

# Filter operators; the second tuple counts as inequality in the query rules.
FILTER_OPS = ("=", "<", "<=", ">", ">=", "!=", "IN", "NOT_IN")
INEQUALITY_OPS = ("<", "<=", ">", ">=", "!=", "NOT_IN")

# What happens to a missing cell.
MISSING_POLICIES = ("omit", "null", "error")

# Identifier kinds of a key part.
IDENTIFIER_KINDS = ("name", "id", "auto")

# Write modes and row actions.
WRITE_MODES = ("insert", "update", "upsert")
WRITE_ACTIONS = ("create", "update", "upsert", "insert", "patch", "delete")
SKIP_ACTION = "skip"
ERROR_ACTION = "error"

# Reasons and row errors of a write plan.
REASON_NOT_STORED = "entity does not exist"
REASON_SAME = "entity unchanged"
REASON_DIFFERENT = "entity changed"
REASON_PATCH_EMPTY = "no properties to patch"
REASON_PATCH_SAME = "patch properties unchanged"
REASON_PATCH_DIFFERENT = "patch properties changed"
ERROR_UPDATE_TARGET = "update target does not exist"
ERROR_INSERT_TARGET = "insert target already exists"
ERROR_READ_ONLY = "read_only prevents write execution"

# Aggregate metrics of the frame model.
METRICS = ("count", "sum", "mean", "min", "max")

# Audit stamping modes.
STAMP_MODES = ("missing", "always", "never")

# What inference does with a property seen with several types.
MIXED_TYPE_POLICIES = ("object", "string", "error")

# Geo point ranges.
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)

# System columns of an entity table.
KEY = "__key__"
NS = "__ns__"
PATH = "__path__"
BUCKET = "__b__"
PRESENT = "__present__"
UNINDEXED = "__unindexed__"
DIGEST = "__digest__"
SYSTEM_COLUMNS = (KEY, NS, PATH, BUCKET, PRESENT, UNINDEXED, DIGEST)

# Errors of keys outside a bound ancestor.
ERROR_SCOPE = "the key lies outside the bound ancestor"
ERROR_SCOPE_NAMESPACE = "the key's namespace differs from the bound ancestor's"
