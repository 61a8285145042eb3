"""Constants, word lists, type names, patterns and text formats that results depend on."""

# Catalog limits
MAX_CATALOG_ROWS = 70_000
MAX_TABLE_ROWS = 1_000
QUERIES_PER_DATASET = 15
BATCH_SIZE = 10
LABEL_TIMEOUT_S = 120

# Dataset limits
MAX_FEATURES = 100
MAX_CLASSES = 10
MIN_SAMPLES = 100
WINDOW_ROWS = 2_000

# Byte units (upper-case run after the digits of a size text)
BYTE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}

# Column types by the name each source gives them
PANDAS_TYPES = {"object": "string", "float64": "float", "int64": "int", "bool": "bool"}
SQL_TYPES = {"TEXT": "string", "FLOAT": "float", "INT": "int", "BIGINT": "int", "BOOLEAN": "bool"}
SHORT_TYPES = {"text": "string", "real": "float"}
SPARK_TO_SQL_TYPES = {
    "string": "TEXT", "float": "FLOAT", "double": "FLOAT", "int": "INT", "smallint": "INT",
    "bigint": "BIGINT", "boolean": "BOOLEAN", "timestamp": "DATETIME", "date": "DATE",
}

# Query status and comparison verdict
VALID, EMPTY, ERROR = "Valid", "Empty", "Error"
CORRECT, COMPARISON, FAILED = "correct", "comparison", "error"

# SQL keywords, found as whole lower-case words
KEYWORDS = [
    "group", "join", "where", "from", "like", "in", "avg", "min", "max", "count", "sum",
    "or", "and", "not", "order", "having", "intersect", "union", "limit", "except",
]
KEYWORDS_SHORT = [k for k in KEYWORDS if k not in ("from", "sum")]
KEYWORD_LABELS = {"group": "group by", "order": "order by"}

# Answer labels and patterns
SQL_LABEL = "SQL"
ANSWER_LABEL = "REL"
NUMBERED_ANSWER = r"\d+.REL:"
ANSWER_LABEL_CHARS = "REL:"
CODE_BLOCK_BREAK = r"```\s*\d+."
BLANK_LINE_BREAK = r"\n *\n"
LEADING_NUMBER = r"^\d+."
SQL_NOISE = ["SQL:", "SQL", "code:", "Code:"]

# Prompt wording
SCHEMA_PROMPT_HEAD = (
    "\nWe have a SQL database with {n} tables. For each table, here is the schema and a sample row data.\n"
)
SCHEMA_PROMPT_TABLE = "\nSchema for table {i}:\n{schema}\nA sample row data from table {i}:\n{row}\n"
SCHEMA_PROMPT_TAIL = (
    "\nConsider the typical users who access this database. What kind of SQLite SELECT queries would they write? "
    "List {count} examples SQL code that are directly executable{complexity}, each following a description.\n"
    "{joins} Reply in the format of a description and the SQL code for each example\n"
)
SCHEMA_PROMPT_COMPLEXITY = " with relatively high complexity"
SCHEMA_PROMPT_JOINS = "If possible, use joins."
TARGET_PROMPT_HEAD = (
    "Consider a machine learning model that takes a few numeric input columns and predict "
    "a single classification target column. Given the following schema of a data table, suggest "
    "the input columns and target column, such that the target may be predicted"
    "from the inputs non-trivially. \nSchema: "
)
TARGET_PROMPT_TAIL = "\nRespond in JSON format with 'input_columns' and 'output_column'."
