"""Column names of the driver tables, in file order, with a flag for text columns.

Used only to write the oracle SQL (which cannot look at a Spark schema); the Spark side always
reads the real schema from the files.
"""

DRIVER_COLUMNS: dict[str, list[tuple[str, bool]]] = {
    "region": [("r_regionkey", False), ("r_name", True)],
    "nation": [("n_nationkey", False), ("n_name", True), ("n_regionkey", False)],
    "customer": [("c_custkey", False), ("c_name", True), ("c_nationkey", False), ("c_acctbal", False), ("c_mktsegment", True)],
    "supplier": [("s_suppkey", False), ("s_name", True), ("s_nationkey", False), ("s_acctbal", False)],
    "part": [("p_partkey", False), ("p_name", True), ("p_brand", True), ("p_type", True), ("p_size", False), ("p_retailprice", False)],
    "orders": [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", True), ("o_totalprice", False),
               ("o_orderdate", False), ("o_orderpriority", True)],
    "lineitem": [("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False), ("l_linenumber", False),
                 ("l_quantity", False), ("l_extendedprice", False), ("l_discount", False), ("l_tax", False),
                 ("l_returnflag", True), ("l_linestatus", True), ("l_shipdate", False)],
    "events": [("event_id", False), ("ts", False), ("user_id", False), ("event_type", True), ("value", False), ("props", True)],
    "documents": [("doc_id", False), ("text", True), ("lang", True), ("source", True), ("n_chars", False)],
    "embeddings": [("vec_id", False), ("embedding", False), ("label", False)],
    "pages": [("page_id", False), ("url", True), ("html", True)],
    "benchmark": [("item_id", False), ("text", True)],
    "labels": [("doc_id", False), ("quality", False), ("toxic", False)],
    "conversations": [("conv_id", False), ("turn", False), ("role", True), ("text", True)],
}

# Natural keys used by the profiling queries.
DRIVER_KEYS: dict[str, list[str]] = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}

# Numeric columns of each table.
DRIVER_NUMBERS: dict[str, list[str]] = {
    table: [c for c, text in columns if not text and c not in ("o_orderdate", "l_shipdate", "ts", "embedding")]
    for table, columns in DRIVER_COLUMNS.items()
}
