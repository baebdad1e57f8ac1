"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the pre-registered views of the driver tables. Itemsets are rendered as
``'a;b;'`` text, counts as BIGINT, ratios through the same integer HALF_UP form the
Spark side uses, so values hash identically in both engines. A size-k itemset
is a k-way self-join of the transaction pairs on ``tid`` with ascending items.
"""

from __future__ import annotations

import math

from cohortmine.plans.catalog import (
    DENSE_MAX_SIZE,
    DENSE_MIN_SUPPORT,
    DENSE_MIN_VALUE,
    M1_LABELS,
    M1_MIN_VALUE,
    M1_SPARSE_MIN_VALUE,
    M2_FEATURE,
    M2_LABELS,
    M2_MIN_VALUE,
    MIN_CONFIDENCE,
    MIN_SUPPORT,
    REFERENCE_MIN_SUPPORT,
    ROWS_MIN_SUPPORT,
    SPARSE_MIN_SUPPORT,
)


def _jtrim(x: str) -> str:
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _labels_cte(name: str, table: str, id_col: str, label_col: str, labels) -> str:
    return f"""{name} AS (
  SELECT subject_id, {_jtrim('tok')} AS label
  FROM (SELECT {id_col} AS subject_id, unnest(string_split({_jtrim(label_col)}, ' ')) AS tok
        FROM {table}) t
  WHERE {_jtrim('tok')} IN ({_in_list(labels)}))"""


M2_BASE = (
    "WITH " + _labels_cte("m2_labels", "part", "p_partkey", "p_name", M2_LABELS) + """,
m2_meas AS (
  SELECT l_partkey AS subject_id, l_linenumber AS feature_id, l_extendedprice AS value
  FROM lineitem),
m2_strong AS (
  SELECT subject_id, feature_id, value FROM m2_meas
  WHERE feature_id = """ + str(M2_FEATURE) + f" AND value > {_dbl(M2_MIN_VALUE)} AND NOT isnan(value))\n"
)


def _m1_base(min_value: float = M1_MIN_VALUE) -> str:
    return (
        "WITH " + _labels_cte("m1_labels", "customer", "c_custkey", "c_mktsegment", M1_LABELS)
        + f""",
m1_cohort AS (SELECT DISTINCT subject_id FROM m1_labels),
m1_meas AS (
  SELECT o.o_custkey AS subject_id,
         CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS feature_id,
         l.l_extendedprice AS value
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN orders o ON l.l_orderkey = o.o_orderkey),
m1_cohort_meas AS (
  SELECT subject_id, feature_id, value FROM m1_meas
  WHERE value > {_dbl(min_value)} AND NOT isnan(value)
    AND subject_id IN (SELECT subject_id FROM m1_cohort)),
tx AS (SELECT DISTINCT subject_id AS tid, feature_id AS item FROM m1_cohort_meas),
nn AS (SELECT count(DISTINCT tid) AS n FROM tx)
"""
    )


def _ratio(cnt: str) -> str:
    return f"(CAST({cnt} AS DOUBLE) / CAST((SELECT n FROM nn) AS DOUBLE))"


def _passes(cnt: str, s: float, mode: str) -> str:
    r = _ratio(cnt)
    if mode == "reference":
        r = f"CAST(CAST({r} AS FLOAT) AS DOUBLE)"
    return f"{r} > {_dbl(s)}"


def _itemstr(cols: list[str]) -> str:
    return " || ".join(f"CAST({c} AS VARCHAR) || ';'" for c in cols)


def _level_ctes(max_k: int, s: float, mode: str = "exact") -> str:
    """CTEs L1..L{max_k} (items text, cnt) plus f = pairs of frequent items."""
    ctes = [f""", L1 AS (
  SELECT item AS i1, count(*) AS cnt FROM tx GROUP BY item
  HAVING {_passes('count(*)', s, mode)}),
f AS (SELECT tid, item FROM tx WHERE item IN (SELECT i1 FROM L1))"""]
    for k in range(2, max_k + 1):
        aliases = [f"x{j}" for j in range(1, k + 1)]
        joins = " ".join(f"JOIN f {a} ON {a}.tid = x1.tid AND {a}.item > {p}.item"
                         for p, a in zip(aliases, aliases[1:]))
        cnt = "count(*)" if (mode == "exact" or k < 2) else f"(count(*) // {math.factorial(k - 1)})"
        sel = ", ".join(f"{a}.item AS i{j}" for j, a in enumerate(aliases, 1))
        grp = ", ".join(str(j) for j in range(1, k + 1))
        ctes.append(f""",
L{k} AS (
  SELECT {sel}, {cnt} AS cnt FROM f x1 {joins}
  GROUP BY {grp} HAVING {_passes(cnt, s, mode)})""")
    return "".join(ctes)


def _levels_union(max_k: int) -> str:
    parts = []
    for k in range(1, max_k + 1):
        cols = [f"i{j}" for j in range(1, k + 1)]
        parts.append(f"SELECT {_itemstr(cols)} AS items, {k} AS k, CAST(cnt AS BIGINT) AS cnt "
                     f"FROM L{k}")
    return "\nUNION ALL ".join(parts)


def _subsets_of_triples() -> str:
    """(items, antecedent, consequent, cnt) for every proper subset of each L3 row,
    masks 1..6 (bit i selects the i-th item)."""
    rows = []
    cols = ["i1", "i2", "i3"]
    for mask in range(1, 7):
        ante = [c for i, c in enumerate(cols) if mask >> i & 1]
        cons = [c for i, c in enumerate(cols) if not mask >> i & 1]
        rows.append(f"SELECT {_itemstr(cols)} AS items, {_itemstr(ante)} AS antecedent, "
                    f"{_itemstr(cons)} AS consequent, CAST(cnt AS BIGINT) AS cnt FROM L3")
    return "\nUNION ALL ".join(rows)


def _m1_mining(max_k: int, s: float = MIN_SUPPORT, mode: str = "exact",
               min_value: float = M1_MIN_VALUE) -> str:
    return _m1_base(min_value) + _level_ctes(max_k, s, mode)


def _dense() -> str:
    return _m1_mining(DENSE_MAX_SIZE, DENSE_MIN_SUPPORT, min_value=DENSE_MIN_VALUE)


def _dense_sets() -> str:
    """The dense itemsets as lists beside their text: s(items, k, cnt, xs)."""
    parts = []
    for k in range(1, DENSE_MAX_SIZE + 1):
        cols = [f"i{j}" for j in range(1, k + 1)]
        parts.append(f"SELECT {_itemstr(cols)} AS items, {k} AS k, CAST(cnt AS BIGINT) AS cnt, [{', '.join(cols)}] AS xs FROM L{k}")
    return _dense() + ",\ns AS (" + "\nUNION ALL ".join(parts) + ")"


def _sparse() -> str:
    """Customer and supplier baskets with the pairs counted."""
    return f"""WITH tx AS (SELECT DISTINCT o_custkey AS tid, CAST(l_suppkey AS INTEGER) AS item
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nn AS (SELECT count(DISTINCT tid) AS n FROM tx)
{_level_ctes(2, SPARSE_MIN_SUPPORT)}"""


_COUNTED = f"""counted AS (
  SELECT {_itemstr(['i1'])} AS items, CAST(cnt AS BIGINT) AS cnt FROM L1
  UNION ALL SELECT {_itemstr(['i1', 'i2'])}, CAST(cnt AS BIGINT) FROM L2)"""

_RULE_COMPLEMENT = f"""subs AS ({_subsets_of_triples()}),
{_COUNTED},
rc AS (
  SELECT s.antecedent, s.consequent, s.cnt, c.cnt AS ante_cnt
  FROM subs s JOIN counted c ON s.antecedent = c.items)"""


def _fp_rules_sql() -> str:
    """Spark ML FP-growth rules: itemsets with freq >= ceil(minSupport*n), every
    single-item consequent, confidence = freq(X)/freq(X - c) >= minConfidence."""
    minc = f"ceil({_dbl(MIN_SUPPORT)} * CAST((SELECT n FROM nn) AS DOUBLE))"
    # Levels P1..P4 with FP-growth's inclusive bar on the raw count.
    ctes = [f""", P1 AS (SELECT item AS i1, count(*) AS cnt FROM tx GROUP BY item
  HAVING count(*) >= {minc}),
g AS (SELECT tid, item FROM tx WHERE item IN (SELECT i1 FROM P1))"""]
    for k in range(2, 5):
        aliases = [f"x{j}" for j in range(1, k + 1)]
        joins = " ".join(f"JOIN g {a} ON {a}.tid = x1.tid AND {a}.item > {p}.item"
                         for p, a in zip(aliases, aliases[1:]))
        sel = ", ".join(f"{a}.item AS i{j}" for j, a in enumerate(aliases, 1))
        grp = ", ".join(str(j) for j in range(1, k + 1))
        ctes.append(f""",
P{k} AS (SELECT {sel}, count(*) AS cnt FROM g x1 {joins}
  GROUP BY {grp} HAVING count(*) >= {minc})""")
    allsets = "\nUNION ALL ".join(
        f"SELECT {_itemstr([f'i{j}' for j in range(1, k + 1)])} AS items, cnt FROM P{k}"
        for k in range(1, 5))
    rules = []
    for k in range(2, 5):
        cols = [f"i{j}" for j in range(1, k + 1)]
        for drop in range(k):
            ante = [c for j, c in enumerate(cols) if j != drop]
            rules.append(f"SELECT {_itemstr(ante)} AS antecedent, {_itemstr([cols[drop]])} "
                         f"AS consequent, cnt FROM P{k}")
    return (_m1_base() + "".join(ctes) + f""",
allsets AS ({allsets}),
cand AS ({chr(10).join(['UNION ALL ' + r if i else r for i, r in enumerate(rules)])})
SELECT c.antecedent, c.consequent, CAST(c.cnt AS DOUBLE) / CAST(a.cnt AS DOUBLE) AS confidence,
  (CAST(c.cnt AS DOUBLE) / CAST(a.cnt AS DOUBLE))
    / (CAST(b.cnt AS DOUBLE) / CAST((SELECT n FROM nn) AS DOUBLE)) AS lift,
  CAST(c.cnt AS DOUBLE) / CAST((SELECT n FROM nn) AS DOUBLE) AS support
FROM cand c JOIN allsets a ON c.antecedent = a.items JOIN allsets b ON c.consequent = b.items
WHERE CAST(c.cnt AS DOUBLE) / CAST(a.cnt AS DOUBLE) >= {_dbl(MIN_CONFIDENCE)}""")


def _milli(num: str, den: str) -> str:
    return f"(CAST((2000 * {num} + {den}) // (2 * {den}) AS DOUBLE) / CAST(1000.0 AS DOUBLE))"


ORACLE_SQL: dict[str, str] = {
    "label_explode": M2_BASE + "SELECT subject_id, label FROM m2_labels",
    "label_counts": M2_BASE + """SELECT l.label, CAST(count(*) AS BIGINT) AS cnt
FROM m2_labels l JOIN m2_strong m ON l.subject_id = m.subject_id GROUP BY l.label""",
    "subject_labels": M2_BASE + """SELECT subject_id, string_agg(label, ';' ORDER BY label) AS labels
FROM (SELECT DISTINCT subject_id, label FROM m2_labels) d GROUP BY subject_id""",
    "strong_measurements": M2_BASE + "SELECT subject_id, feature_id, value FROM m2_strong",
    "cohort_subjects": _m1_base() + "SELECT subject_id FROM m1_cohort",
    "cohort_measurements": _m1_base() + "SELECT subject_id, feature_id, value FROM m1_cohort_meas",
    "transactions": _m1_base() + "SELECT tid, item FROM tx",
    "baskets": _m1_base() + """SELECT tid, string_agg(CAST(item AS VARCHAR), ';' ORDER BY item) || ';' AS items
FROM tx GROUP BY tid""",
    "transaction_count": _m1_base() + "SELECT CAST(n AS BIGINT) AS n FROM nn",
    "transaction_count_sparse": _m1_base(M1_SPARSE_MIN_VALUE) + "SELECT CAST(n AS BIGINT) AS n FROM nn",
    "item_support": _m1_mining(1) + "\nSELECT i1 AS item, CAST(cnt AS BIGINT) AS cnt FROM L1",
    "item_row_counts": _m1_base() + """SELECT feature_id AS item, CAST(count(*) AS BIGINT) AS cnt
FROM m1_cohort_meas GROUP BY feature_id""",
    "candidate_pairs": _m1_mining(1) + f"""
SELECT {_itemstr(['a.item', 'b.item'])} AS items, CAST(count(*) AS BIGINT) AS cnt
FROM f a JOIN f b ON a.tid = b.tid AND a.item < b.item GROUP BY a.item, b.item""",
    "itemsets_pairs": _m1_mining(2) + f"""
SELECT {_itemstr(['i1', 'i2'])} AS items, CAST(cnt AS BIGINT) AS cnt FROM L2""",
    "itemsets_triples": _m1_mining(3) + f"""
SELECT {_itemstr(['i1', 'i2', 'i3'])} AS items, CAST(cnt AS BIGINT) AS cnt FROM L3""",
    "itemsets_all": _m1_mining(3) + "\n" + _levels_union(3),
    "itemsets_tidjoin": _m1_mining(3) + "\n" + _levels_union(3),
    "itemsets_reference_counts": _m1_mining(3, REFERENCE_MIN_SUPPORT, "reference") + "\n"
    + _levels_union(3),
    "itemsets_fpgrowth": _m1_mining(3) + "\n" + _levels_union(3),
    "itemsets_reference_rows": _m1_base(DENSE_MIN_VALUE) + f""",
L1 AS (
  SELECT feature_id AS i1, count(*) AS cnt FROM m1_cohort_meas GROUP BY feature_id
  HAVING {_passes('count(*)', ROWS_MIN_SUPPORT, 'reference')}),
f AS (SELECT tid, item FROM tx WHERE item IN (SELECT i1 FROM L1)),
L2 AS (
  SELECT x1.item AS i1, x2.item AS i2, count(*) AS cnt
  FROM f x1 JOIN f x2 ON x2.tid = x1.tid AND x2.item > x1.item GROUP BY 1, 2
  HAVING {_passes('count(*)', ROWS_MIN_SUPPORT, 'reference')})
{_levels_union(2)}""",
    "itemsets_dense": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_dense_fpgrowth": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_vertical": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_partition": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_sampled": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_incremental": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "itemsets_low_support": _sparse() + "\n" + _levels_union(2),
    "pairs_hashed": _sparse() + f"""
SELECT {_itemstr(['i1', 'i2'])} AS items, CAST(cnt AS BIGINT) AS cnt FROM L2""",
    "closed_itemsets": _dense_sets() + """
SELECT items, k, cnt FROM s WHERE NOT EXISTS (
  SELECT 1 FROM s z WHERE z.k > s.k AND z.cnt = s.cnt AND list_has_all(z.xs, s.xs))""",
    "maximal_itemsets": _dense_sets() + """
SELECT items, k, cnt FROM s WHERE NOT EXISTS (SELECT 1 FROM s z WHERE z.k > s.k AND list_has_all(z.xs, s.xs))""",
    "itemsets_from_closed": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "rules_grown": _dense() + ",\n" + _RULE_COMPLEMENT + f"""
SELECT antecedent, consequent, {_milli('cnt', 'ante_cnt')} AS confidence FROM rc
WHERE {_milli('cnt', 'ante_cnt')} > {_dbl(MIN_CONFIDENCE)}""",
    "report_dense": _dense() + f"""
SELECT {_milli('cnt', '(SELECT n FROM nn)')} AS support, {_itemstr(['i1', 'i2', 'i3'])} AS items
FROM L3""",
    "rules_dense": _dense() + ",\n" + _RULE_COMPLEMENT + f"""
SELECT antecedent, consequent, {_milli('cnt', 'ante_cnt')} AS confidence FROM rc
WHERE {_milli('cnt', 'ante_cnt')} > {_dbl(MIN_CONFIDENCE)}""",
    "support_report": _m1_mining(3) + f"""
SELECT {_milli('cnt', '(SELECT n FROM nn)')} AS support, {_itemstr(['i1', 'i2', 'i3'])} AS items
FROM L3""",
    "itemset_subsets": _m1_mining(3) + f""",
subs AS ({_subsets_of_triples()})
SELECT items, antecedent AS subset, cnt FROM subs""",
    "rule_complement": _m1_mining(3) + ",\n" + _RULE_COMPLEMENT + """
SELECT antecedent, consequent, cnt, ante_cnt FROM rc""",
    "association_rules": _m1_mining(3) + ",\n" + _RULE_COMPLEMENT + f"""
SELECT antecedent, consequent, {_milli('cnt', 'ante_cnt')} AS confidence FROM rc
WHERE {_milli('cnt', 'ante_cnt')} > {_dbl(MIN_CONFIDENCE)}""",
    "fp_itemsets": _m1_mining(4) + "\n" + _levels_union(4),
    "fp_rules": _fp_rules_sql(),
    "measurement_lines_parsed": """
SELECT CAST(l_partkey AS VARCHAR) AS subject_id, CAST(l_linenumber AS INTEGER) AS feature_id,
  CAST(l_extendedprice AS DOUBLE) AS value FROM lineitem""",
    "subject_lines_parsed": """SELECT CAST(c_custkey AS VARCHAR) AS subject_id, c_mktsegment AS labels,
  CAST(c_custkey AS VARCHAR) AS last FROM customer""",
    "label_count_lines": M2_BASE + """SELECT '(' || label || ',' || cnt || ')' AS value
FROM (SELECT l.label, count(*) AS cnt FROM m2_labels l JOIN m2_strong m ON l.subject_id = m.subject_id GROUP BY l.label) c""",
    "itemset_lines": _dense() + f"""
SELECT '(' || cnt || ',' || items || ')' AS value FROM ({_levels_union(DENSE_MAX_SIZE)}) s""",
    "itemset_lines_parsed": _dense() + "\n" + _levels_union(DENSE_MAX_SIZE),
    "report_lines": _dense() + f"""
SELECT CAST({_milli('cnt', '(SELECT n FROM nn)')} AS VARCHAR) || chr(9) || i1 || chr(9) || i2 || chr(9) || i3 AS value
FROM L3""",
    "rule_lines": _dense() + ",\n" + _RULE_COMPLEMENT + f"""
SELECT antecedent || chr(9) || consequent || chr(9) || CAST({_milli('cnt', 'ante_cnt')} AS VARCHAR) AS value FROM rc
WHERE {_milli('cnt', 'ante_cnt')} > {_dbl(MIN_CONFIDENCE)}""",
    "basket_lines_parsed": """
SELECT string_agg(w, ' ' ORDER BY w) AS items
FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) t WHERE w <> '' GROUP BY p_partkey""",
    "total_text_length": """SELECT CAST(sum(length(line)) AS BIGINT) AS total_len,
       CAST(count(*) AS BIGINT) AS n_lines
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) t""",
}

# The same rows by other ways: files of the registered line format, measurements stored by subject.
ORACLE_SQL |= {
    "measurement_lines_source": ORACLE_SQL["measurement_lines_parsed"],
    "itemset_lines_source": ORACLE_SQL["itemset_lines_parsed"],
    "transactions_stored": ORACLE_SQL["transactions"],
    "baskets_stored": ORACLE_SQL["baskets"],
    "label_counts_stored": ORACLE_SQL["label_counts"],
}
