"""A workload of SQL queries over the driver tables, with the status each one must get."""

TABLES_OF = {
    "sales": ["customer", "orders", "nation", "region"],
    "lines": ["lineitem", "part", "supplier"],
    "web": ["events"],
    "texts": ["documents", "labels", "pages", "conversations"],
    "vectors": ["embeddings", "benchmark"],
}

# (dataset, SQL, expected status)
WORKLOAD = [
    ("sales", "SELECT c_name, c_mktsegment FROM customer", "Valid"),
    ("sales", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000", "Valid"),
    ("sales", "SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY c_mktsegment ORDER BY n DESC", "Valid"),
    ("sales", "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_acctbal > 0", "Valid"),
    ("sales", "SELECT c_name FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderkey IS NULL AND c.c_custkey < 0", "Empty"),
    ("sales", "SELECT o_custkey, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1", "Valid"),
    ("sales", "SELECT MAX(o_totalprice), MIN(o_totalprice) FROM orders", "Valid"),
    ("sales", "SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders", "Valid"),
    ("sales", "SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders", "Empty"),
    ("sales", "SELECT c_nationkey FROM customer UNION SELECT n_nationkey FROM nation", "Valid"),
    ("sales", "SELECT c_phone FROM customer", "Error"),
    ("sales", "SELECT c_name, AVG(c_acctbal) FROM customer GROUP BY c_mktsegment", "Error"),
    ("sales", "SELECT o_orderkey FROM orders WHERE o_custkey = (SELECT c_custkey FROM customer)", "Error"),
    ("sales", "SELECT o_orderkey FROM orders WHERE o_totalprice < 0", "Empty"),
    ("sales", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 10", "Valid"),
    ("lines", "SELECT AVG(l_extendedprice) FROM lineitem WHERE l_quantity > 10 OR l_discount > 0.05", "Valid"),
    ("lines", "SELECT l_returnflag, SUM(l_quantity), SUM(l_extendedprice) FROM lineitem GROUP BY l_returnflag", "Valid"),
    ("lines", "SELECT p_name FROM part WHERE p_name LIKE '%ring%' AND p_size IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)", "Valid"),
    ("lines", "SELECT COUNT(DISTINCT l_suppkey) FROM lineitem WHERE NOT l_returnflag = 'R'", "Valid"),
    ("lines", "SELECT s_name FROM supplier WHERE s_acctbal = (SELECT MAX(s_acctbal) FROM supplier)", "Valid"),
    ("lines", "SELECT s_name FROM supplier WHERE s_name LIKE 'Nobody%'", "Empty"),
    ("lines", "SELECT l_orderkey FROM lineitem JOIN partsupp ON l_partkey = ps_partkey", "Error"),
    ("lines", "SELEC l_orderkey FROM lineitem", "Error"),
    ("lines", "SELECT p_type, COUNT(*) FROM part GROUP BY p_type HAVING MIN(p_size) > 1000", "Empty"),
    ("lines", "SELECT l_linenumber, COUNT(*) FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY l_linenumber", "Valid"),
    ("web", "SELECT event_type, AVG(value) AS mean_value FROM events GROUP BY event_type ORDER BY mean_value", "Valid"),
    ("web", "SELECT user_id FROM events WHERE event_type = 'purchase' LIMIT 5", "Valid"),
    ("web", "SELECT user_id FROM events WHERE event_type = 'refund'", "Empty"),
    ("web", "SELECT COUNT(*) FROM events WHERE value > (SELECT AVG(value) FROM events)", "Valid"),
    ("web", "SELECT event_type, MEDIAN_OF(value) FROM events GROUP BY event_type", "Error"),
    ("texts", "SELECT lang, COUNT(*) FROM documents GROUP BY lang", "Valid"),
    ("texts", "SELECT d.source, MAX(l.quality) FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source", "Valid"),
    ("texts", "SELECT text FROM conversations WHERE role IN ('robot', 'oracle')", "Empty"),
    ("texts", "SELECT doc_id FROM documents WHERE lang = 'en' AND", "Error"),
    ("vectors", "SELECT label, COUNT(*) FROM embeddings GROUP BY label", "Valid"),
    ("vectors", "SELECT item_id FROM benchmark WHERE item_id < 0", "Empty"),
    ("vectors", "SELECT SUM(embedding) FROM embeddings", "Error"),
]


def numbered():
    """(ref, query_idx, sql, status) with the place of each query in its dataset."""
    seen: dict[str, int] = {}
    for ref, sql, status in WORKLOAD:
        place = seen.get(ref, 0)
        seen[ref] = place + 1
        yield ref, place, sql, status


def values_sql() -> str:
    """The same rows as a SQL VALUES list named w(ref, query_idx, sql, status)."""
    rows = []
    for ref, place, sql, status in numbered():
        quoted = sql.replace("'", "''")
        rows.append(f"('{ref}', {place}, '{quoted}', '{status}')")
    return "(VALUES " + ", ".join(rows) + ") w(ref, query_idx, sql, status)"
