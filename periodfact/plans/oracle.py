"""Equivalent SQL of the verification plans, for an independent engine (DuckDB).

Parity rules (see the README):

* means are an exact ``DECIMAL`` sum divided by the count, in both engines;
* half-up rounding is applied to the decimal text of the double, which is
  what Spark's ``round`` and its double-to-decimal cast do;
* division by zero is written as ``/ nullif(x, 0)`` (``try_divide`` in Spark);
* ties are always broken by an explicit rank or key.
"""

from __future__ import annotations

from periodfact.plans.queries import LABELS, SHARE_COLS
from periodfact.plans.tables import CATEGORIES, SEGMENT_CATEGORY, col_name

CATS = [col_name(c) for c in CATEGORIES]
CAT_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"


def P(ts: str) -> str:
    return f"CAST(year({ts}) AS INTEGER)"


def R(x: str, scale: int = 2) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {scale}) AS DOUBLE)"


def D(x: str, precision: int = 10, scale: int = 2) -> str:
    return (f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {scale}) "
            f"AS DECIMAL({precision},{scale}))")


def ES(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,2))) AS DOUBLE)"


def EM(x: str) -> str:
    return f"({ES(x)} / count({x}))"


def FOLD(x: str) -> str:
    return f"lower(regexp_replace(trim({x}), '\\s+', ' ', 'g'))"


MEAN_BY_PERIOD = f"""
SELECT {P('l_shipdate')} AS period,
       {R(EM('l_quantity'))} AS avg_quantity,
       {R(EM('l_extendedprice'))} AS avg_extendedprice,
       {R(EM('l_discount'))} AS avg_discount,
       {R(EM('l_tax'))} AS avg_tax
FROM lineitem GROUP BY 1
"""

MEAN_JOIN_INNER = f"""
WITH a AS (SELECT {P('l_shipdate')} AS period, {R(EM('l_quantity'))} AS avg_quantity,
                  {R(EM('l_extendedprice'))} AS avg_extendedprice
           FROM lineitem GROUP BY 1),
     b AS (SELECT {P('o_orderdate')} AS period, {R(EM('o_totalprice'))} AS avg_totalprice
           FROM orders GROUP BY 1)
SELECT a.period, avg_quantity, avg_extendedprice, avg_totalprice
FROM a JOIN b ON a.period = b.period ORDER BY a.period
"""

PERIOD_SLICE = f"""
WITH a AS (SELECT {P('l_shipdate')} AS period, {R(EM('l_quantity'))} AS avg_quantity,
                  {R(EM('l_extendedprice'))} AS avg_extendedprice
           FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY 1),
     b AS (SELECT {P('o_orderdate')} AS period, {R(EM('o_totalprice'))} AS avg_totalprice
           FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1)
SELECT a.period, avg_quantity, avg_extendedprice, avg_totalprice
FROM a LEFT JOIN b ON a.period = b.period
"""

SUM_ALL_BY_PERIOD = f"""
SELECT {P('l_shipdate')} AS period, {ES('l_quantity')} AS l_quantity,
       {ES('l_extendedprice')} AS l_extendedprice, {ES('l_discount')} AS l_discount,
       {ES('l_tax')} AS l_tax
FROM lineitem GROUP BY 1
"""

ROW_TOTAL_BY_PERIOD = f"""
SELECT {P('l_shipdate')} AS period,
       CAST(sum(coalesce(CAST(l_quantity AS DECIMAL(28,2)), 0)
              + coalesce(CAST(l_extendedprice AS DECIMAL(28,2)), 0)
              + coalesce(CAST(l_discount AS DECIMAL(28,2)), 0)
              + coalesce(CAST(l_tax AS DECIMAL(28,2)), 0)) AS DOUBLE) AS row_total
FROM lineitem GROUP BY 1
"""

_MONTH = "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')"
PERIOD_FROM_CODE = f"""
SELECT TRY_CAST(substring(code, 2, 4) AS INTEGER) AS period, {ES('o_totalprice')} AS o_totalprice
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN '_n/a_' || {_MONTH}
                  ELSE '_' || CAST(year(o_orderdate) AS VARCHAR) || '_' || {_MONTH} END AS code,
             o_totalprice
      FROM orders)
GROUP BY 1
"""

MEASURE_GAP = f"""
SELECT period, avg_tax, avg_discount, avg_tax - avg_discount AS gap
FROM (SELECT {P('l_shipdate')} AS period, {R(EM('l_tax'))} AS avg_tax,
             {R(EM('l_discount'))} AS avg_discount
      FROM lineitem GROUP BY 1)
"""

_CHANGE = R("(avg_totalprice - lag(avg_totalprice) OVER w) / nullif(lag(avg_totalprice) OVER w, 0) * 100")
_YEARLY_PRICE = f"(SELECT {P('o_orderdate')} AS period, {R(EM('o_totalprice'))} AS avg_totalprice FROM orders GROUP BY 1)"

LAG_CHANGE = f"""
SELECT period, avg_totalprice, {_CHANGE} AS avg_totalprice_change
FROM {_YEARLY_PRICE} m
WINDOW w AS (ORDER BY period)
"""

LAG_CHANGE_BY_SEGMENT = f"""
SELECT c_mktsegment, period, avg_totalprice, {_CHANGE} AS avg_totalprice_change
FROM (SELECT c_mktsegment, {P('o_orderdate')} AS period, {R(EM('o_totalprice'))} AS avg_totalprice
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) m
WINDOW w AS (PARTITION BY c_mktsegment ORDER BY period)
"""

MEAN_CHANGE = f"""
SELECT {R(EM('ch'))} AS mean_change
FROM (SELECT {_CHANGE} AS ch FROM {_YEARLY_PRICE} m WINDOW w AS (ORDER BY period))
"""

SPINE_LEFT_JOIN = f"""
WITH base AS (SELECT {P('l_shipdate')} AS period, {R(EM('l_quantity'))} AS avg_quantity
              FROM lineitem GROUP BY 1),
     o AS {_YEARLY_PRICE},
     e AS (SELECT {P('ts')} AS period, {R(EM('value'))} AS avg_event_value FROM events GROUP BY 1)
SELECT base.period, avg_quantity, avg_totalprice, avg_event_value
FROM base LEFT JOIN o ON base.period = o.period LEFT JOIN e ON base.period = e.period
"""

FILTER_CATEGORY = f"""
SELECT c_custkey, c_name, c_nationkey, segment_label
FROM (SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_acctbal < 0 THEN c_mktsegment || '  ' ELSE lower(c_mktsegment) END
               AS segment_label
      FROM customer)
WHERE {FOLD('segment_label')} = 'building'
"""

_PARSED = ("TRY_CAST(replace(regexp_replace(price_text, '[\\s\\x{00A0}\\x{202F}]', '', 'g'), "
           "',', '.') AS DOUBLE)")
PARSE_LOCALE_NUMBER = f"""
SELECT o_orderkey, price_text, {_PARSED} AS price,
       (price_text IS NOT NULL AND {_PARSED} IS NULL) AS rejected
FROM (SELECT o_orderkey,
             CASE o_orderpriority WHEN '1-URGENT' THEN replace(s, '.', ',')
                                  WHEN '2-HIGH' THEN substring(s, 1, 1) || ' ' || substring(s, 2, 64)
                                  WHEN '5-LOW' THEN 'n/a'
                                  ELSE s END AS price_text
      FROM (SELECT o_orderkey, o_orderpriority,
                   CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS s
            FROM orders))
"""

_LABEL_CASES = " ".join(f"WHEN '{lab.lower()}' THEN '{lab}'" for lab in LABELS)
NORMALISE_LABEL = f"""
SELECT label, count(*) AS n_parts, {ES('p_retailprice')} AS sum_retailprice
FROM (SELECT CASE k {_LABEL_CASES} WHEN 'std' THEN 'Standard'
                    ELSE upper(substring(k, 1, 1)) || substring(k, 2) END AS label,
             p_retailprice
      FROM (SELECT {FOLD('raw')} AS k, p_retailprice
            FROM (SELECT CASE WHEN p_size < 15 THEN lower(p_type)
                              WHEN p_size < 35 THEN '  ' || p_type
                              ELSE upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) || ' '
                         END AS raw,
                         p_retailprice
                  FROM part)))
GROUP BY 1
"""

STRIP_PREFIX_CODE = f"""
SELECT code, count(*) AS n_parts, {ES('p_retailprice')} AS sum_retailprice
FROM (SELECT substring('L' || p_brand, 2) AS code, p_retailprice FROM part)
WHERE code IS NOT NULL AND trim(code) <> ''
GROUP BY 1
"""

SAFE_COLUMN_NAMES = """
SELECT r_regionkey AS region_key_as_published_in_the_statistical_yearbook_of,
       r_regionkey + 1 AS region_key_as_published_in_the_statistical_yearbook_of_1,
       r_name,
       CAST(length(r_name) AS INTEGER) AS name_length_in_characters_counted_including_blanks_inside,
       upper(r_name) AS upper_name
FROM region
"""

_SLOT = ("CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, "
         "l_extendedprice) - 1 AS INTEGER) AS slot")
UNPIVOT_BLOCKS = f"SELECT l_orderkey, {_SLOT}, l_partkey AS item, l_quantity AS votes FROM lineitem"

UNPIVOT_LAYOUTS = f"""
SELECT l_orderkey, {_SLOT}, l_partkey AS item, l_quantity AS votes, 'quantity' AS family FROM lineitem
UNION ALL
SELECT l_orderkey, {_SLOT}, l_partkey AS item, l_extendedprice AS votes, 'price' AS family FROM lineitem
"""

# Shared CTEs of the tally chain ---------------------------------------------
_IT = (f"it AS (SELECT {P('l_shipdate')} AS period, l_partkey AS item, sum(l_quantity) AS votes "
       "FROM lineitem GROUP BY 1, 2)")
_PK = ("pk AS (SELECT p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part "
       "WHERE p_partkey IS NOT NULL GROUP BY 1)")
_CT = ("ct AS (SELECT period, pk.p_brand AS code, sum(votes) AS votes "
       "FROM it LEFT JOIN pk ON it.item = pk.p_partkey GROUP BY 1, 2)")
_BT = ("bt AS (SELECT p_brand, arg_min(p_type, p_partkey) AS p_type FROM part "
       "WHERE p_brand IS NOT NULL GROUP BY 1)")
_CAT = ("cat AS (SELECT period, bt.p_type AS category, sum(votes) AS votes "
        "FROM ct LEFT JOIN bt ON ct.code = bt.p_brand GROUP BY 1, 2)")


def _zero_fill(src: str = "cat") -> str:
    cols = ", ".join(f"coalesce(sum(votes) FILTER (WHERE category = '{c}'), 0) AS {col_name(c)}"
                     for c in CATEGORIES)
    return f"z AS (SELECT period, {cols} FROM {src} GROUP BY 1)"


def _shares(total: str) -> str:
    parts = [f"{c} / nullif({total}, 0) * 100 AS share_{c}" for c in CATS]
    listed = " + ".join(CATS)
    parts.append(f"({total} - ({listed})) / nullif({total}, 0) * 100 AS share_residual")
    return ", ".join(parts)


def _winner(src: str = "cat") -> str:
    return (f"w AS (SELECT period, category AS winner FROM ("
            f"SELECT period, category, row_number() OVER (PARTITION BY period "
            f"ORDER BY votes DESC, coalesce(list_position({CAT_LIST}, category), 0) ASC) AS rn "
            f"FROM {src} WHERE coalesce(list_position({CAT_LIST}, category), 0) > 0 AND votes > 0) "
            f"WHERE rn = 1)")


_CHAIN = ",\n".join([_IT, _PK, _CT, _BT, _CAT])

TALLY_ITEMS = f"""
SELECT {P('l_shipdate')} AS period, l_partkey AS item, sum(l_quantity) AS votes
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1, 2
"""

LOOKUP_FIRST = f"""
WITH {_IT}, {_PK}, {_CT}, {_BT}
SELECT period, code, bt.p_type AS category, votes FROM ct LEFT JOIN bt ON ct.code = bt.p_brand
"""

LOOKUP_CASEFOLD = f"""
WITH n2 AS (SELECT {FOLD('n_name')} AS k, arg_min(n_regionkey, n_nationkey) AS n_regionkey
            FROM nation WHERE n_name IS NOT NULL GROUP BY 1)
SELECT n2.n_regionkey, count(*) AS n_customers, {ES('c_acctbal')} AS acctbal
FROM customer JOIN nation n ON c_nationkey = n.n_nationkey
LEFT JOIN n2 ON {FOLD("lower(n.n_name) || ' '")} = n2.k
GROUP BY 1
"""

UNMATCHED_CODES = f"""
WITH {_PK},
     r AS (SELECT pk.p_brand, l_quantity FROM lineitem LEFT JOIN pk ON l_partkey = pk.p_partkey)
SELECT p_brand, count(*) AS n_rows, sum(l_quantity) AS l_quantity
FROM r
WHERE NOT EXISTS (SELECT 1 FROM part t WHERE t.p_brand < 'Brand#3' AND t.p_brand = r.p_brand)
GROUP BY 1
"""

TALLY_BY_CATEGORY = f"WITH {_CHAIN}\nSELECT period, category, votes FROM cat"

ZERO_FILL_PIVOT = f"WITH {_CHAIN},\n{_zero_fill()}\nSELECT * FROM z"

_TOTAL = "t AS (SELECT period, sum(votes) AS total FROM it GROUP BY 1)"

CATEGORY_SHARES = f"""
WITH {_CHAIN},
{_zero_fill()},
{_TOTAL}
SELECT z.period, total, {_shares('total')}
FROM z LEFT JOIN t ON z.period = t.period
"""

WINNER_CATEGORY = f"WITH {_CHAIN},\n{_winner()}\nSELECT period, winner FROM w"

WINNER_ITEM_CATEGORY = f"""
WITH {_IT},
     w AS (SELECT period, item AS winner_item FROM (
             SELECT period, item, row_number() OVER (PARTITION BY period ORDER BY votes DESC, item ASC) AS rn
             FROM it WHERE item IS NOT NULL) WHERE rn = 1),
     pt AS (SELECT p_partkey, arg_min(p_type, p_partkey) AS p_type FROM part GROUP BY 1)
SELECT period, winner_item, pt.p_type AS category FROM w LEFT JOIN pt ON w.winner_item = pt.p_partkey
"""

_IND = f"""ind AS (SELECT o.period, avg_totalprice, avg_discount, avg_tax
             FROM {_YEARLY_PRICE} o
             LEFT JOIN (SELECT {P('l_shipdate')} AS period, {R(EM('l_discount'))} AS avg_discount,
                               {R(EM('l_tax'))} AS avg_tax FROM lineitem GROUP BY 1) l
               ON o.period = l.period)"""
_TOT = (f"tot AS (SELECT {P('o_orderdate')} AS period, "
        f"CAST(sum(coalesce(CAST(o_totalprice AS DECIMAL(28,2)), 0)) AS DOUBLE) AS orders_value "
        f"FROM orders GROUP BY 1)")


def _fact_select(family: str | None = None) -> str:
    shares = ", ".join(f"{D(c)} AS {c}" for c in SHARE_COLS)
    ind = ", ".join(f"{D(c)} AS {c}" for c in ("avg_totalprice", "avg_discount", "avg_tax"))
    fam = f", '{family}' AS family" if family else ""
    return (f"SELECT sh.period, w.winner, {shares}, {ind}, {D('total_votes', 20)} AS total_votes, "
            f"{D('orders_value', 20)} AS orders_value{fam} "
            f"FROM sh LEFT JOIN w ON sh.period = w.period LEFT JOIN ind ON sh.period = ind.period "
            f"LEFT JOIN tot ON sh.period = tot.period")


def _lineitem_fact(family: str | None = None) -> str:
    return f"""
WITH {_CHAIN},
{_zero_fill()},
{_TOTAL},
sh AS (SELECT z.period, total AS total_votes, {_shares('total')} FROM z LEFT JOIN t ON z.period = t.period),
{_winner()},
{_IND},
{_TOT}
{_fact_select(family)}
"""


_SEG_VALUES = ", ".join(f"('{s}', '{c}')" for s, c in SEGMENT_CATEGORY)


def _orders_fact(family: str | None = None) -> str:
    return f"""
WITH ot AS (SELECT {P('o_orderdate')} AS period, o_custkey AS item, {ES('o_totalprice')} AS votes
            FROM orders GROUP BY 1, 2),
ck AS (SELECT c_custkey, arg_min(c_mktsegment, c_custkey) AS c_mktsegment FROM customer
       WHERE c_custkey IS NOT NULL GROUP BY 1),
seg AS (SELECT * FROM (VALUES {_SEG_VALUES}) s(segment, category)),
cat AS (SELECT period, seg.category AS category, {ES('votes')} AS votes
        FROM ot LEFT JOIN ck ON ot.item = ck.c_custkey LEFT JOIN seg ON ck.c_mktsegment = seg.segment
        GROUP BY 1, 2),
{_zero_fill()},
t AS (SELECT {P('o_orderdate')} AS period, {ES('o_totalprice')} AS total FROM orders GROUP BY 1),
sh AS (SELECT z.period, total AS total_votes, {_shares('total')} FROM z LEFT JOIN t ON z.period = t.period),
{_winner()},
{_IND},
{_TOT}
{_fact_select(family)}
"""


PERIOD_FACT = _lineitem_fact()
FAMILY_UNION = f"({_lineitem_fact('lineitem')})\nUNION ALL\n({_orders_fact('orders')})"

READ_DELIMITED_ROUNDTRIP = "SELECT n_nationkey, n_name, n_regionkey AS period FROM nation"


def _wide_files_fact() -> str:
    slug = {c: "_".join(c.lower().split()) for c in CATEGORIES}
    shares = ", ".join(f"{D(f'{col_name(c)} / nullif(total, 0) * 100')} AS share_{slug[c]}"
                       for c in CATEGORIES)
    listed = " + ".join(col_name(c) for c in CATEGORIES)
    return f"""
WITH o AS (SELECT o_orderkey, {P('o_orderdate')} AS period FROM orders),
lines AS (SELECT l_orderkey, l_partkey AS item, l_quantity AS votes FROM lineitem),
tot AS (SELECT o.period, sum(l_quantity) AS total
        FROM lineitem JOIN o ON l_orderkey = o.o_orderkey GROUP BY 1),
it AS (SELECT o.period, item, sum(votes) AS votes
       FROM lines JOIN o ON l_orderkey = o.o_orderkey GROUP BY 1, 2),
{_PK},
{_BT},
cat AS (SELECT period, bt.p_type AS category, sum(votes) AS votes
        FROM it LEFT JOIN pk ON it.item = pk.p_partkey LEFT JOIN bt ON pk.p_brand = bt.p_brand
        GROUP BY 1, 2),
{_zero_fill()},
{_winner()}
SELECT z.period, 'orders' AS family, w.winner, {shares},
       {D(f'(total - ({listed})) / nullif(total, 0) * 100')} AS share_residual,
       {D('total', 20)} AS total
FROM z JOIN tot ON z.period = tot.period LEFT JOIN w ON z.period = w.period
"""


WIDE_FILES_FACT = _wide_files_fact()

_Q = f"CAST(CAST({R(EM('o_totalprice'))} AS DECIMAL(14,2)) AS DOUBLE)"
INDICATOR_MART_FILES = f"""
WITH q AS (SELECT {P('o_orderdate')} AS period, quarter(o_orderdate) AS qt, {_Q} AS v
           FROM orders GROUP BY 1, 2),
base AS (SELECT period, {R(EM('v'))} AS avg_price FROM q GROUP BY 1),
pr2 AS (SELECT {P('o_orderdate')} AS period, {_Q} AS urgent_price FROM orders
        WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
c AS (SELECT {P('o_orderdate')} AS period, CAST(count(*) AS DOUBLE) AS orders FROM orders GROUP BY 1),
m AS (SELECT {P('l_shipdate')} AS period, {ES('l_quantity')} AS quantity FROM lineitem GROUP BY 1)
SELECT base.period, avg_price, urgent_price, orders, quantity
FROM base LEFT JOIN pr2 ON base.period = pr2.period LEFT JOIN c ON base.period = c.period
LEFT JOIN m ON base.period = m.period
"""


def oracle_sql() -> dict[str, str]:
    return _learning_sql() | {
        "mean_by_period": MEAN_BY_PERIOD,
        "mean_revenue_by_period": f"SELECT {P('l_shipdate')} AS period, {R('avg(l_extendedprice * (1 - l_discount))', 4)} AS avg_revenue FROM lineitem GROUP BY 1",
        "mean_join_inner": MEAN_JOIN_INNER,
        "period_slice": PERIOD_SLICE,
        "sum_all_by_period": SUM_ALL_BY_PERIOD,
        "row_total_by_period": ROW_TOTAL_BY_PERIOD,
        "period_from_code": PERIOD_FROM_CODE,
        "measure_gap": MEASURE_GAP,
        "lag_change": LAG_CHANGE,
        "lag_change_by_segment": LAG_CHANGE_BY_SEGMENT,
        "mean_change": MEAN_CHANGE,
        "spine_left_join": SPINE_LEFT_JOIN,
        "filter_category": FILTER_CATEGORY,
        "parse_locale_number": PARSE_LOCALE_NUMBER,
        "normalise_label": NORMALISE_LABEL,
        "strip_prefix_code": STRIP_PREFIX_CODE,
        "safe_column_names": SAFE_COLUMN_NAMES,
        "unpivot_blocks": UNPIVOT_BLOCKS,
        "unpivot_layouts": UNPIVOT_LAYOUTS,
        "tally_items": TALLY_ITEMS,
        "lookup_first": LOOKUP_FIRST,
        "lookup_casefold": LOOKUP_CASEFOLD,
        "unmatched_codes": UNMATCHED_CODES,
        "tally_by_category": TALLY_BY_CATEGORY,
        "zero_fill_pivot": ZERO_FILL_PIVOT,
        "category_shares": CATEGORY_SHARES,
        "winner_category": WINNER_CATEGORY,
        "winner_item_category": WINNER_ITEM_CATEGORY,
        "period_fact": PERIOD_FACT,
        "family_union": FAMILY_UNION,
        "read_delimited_roundtrip": READ_DELIMITED_ROUNDTRIP,
        "wide_files_fact": WIDE_FILES_FACT,
        "streaming_wide_files_fact": WIDE_FILES_FACT,
        "indicator_mart_files": INDICATOR_MART_FILES,
    }


# Learning ---------------------------------------------------------------------
def _holdout(table: str, key: str, cols: str, seed: int = 42, size: float = 0.2) -> str:
    return (f"SELECT {cols}, row_number() OVER (ORDER BY md5('{seed}|' || CAST({key} AS VARCHAR)), {key}) "
            f"<= CEIL(count(*) OVER () * CAST({size} AS DOUBLE)) AS is_test FROM {table}")


def _marks(text: str = "text") -> str:
    from periodfact.plans.learning import MARKERS
    return ", ".join(f"CAST(len(regexp_extract_all({text}, '{p}')) AS INTEGER) AS {lang}_marks"
                     for lang, p in MARKERS.items())


def _rule() -> str:
    return (f"p AS (SELECT doc_id, lang AS label, CASE WHEN fr_marks >= de_marks AND fr_marks >= es_marks "
            f"AND fr_marks > 0 THEN 'fr' WHEN de_marks >= es_marks AND de_marks > 0 THEN 'de' "
            f"WHEN es_marks > 0 THEN 'es' ELSE 'en' END AS predicted "
            f"FROM (SELECT doc_id, lang, {_marks()} FROM documents))")


_REPORT = """
pairs AS (SELECT label AS a, predicted AS pd, count(*) AS c FROM p GROUP BY 1, 2),
per AS (SELECT class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp,
               CAST(sum(n_predicted) AS BIGINT) AS n_predicted
        FROM (SELECT a AS class, c AS support, CASE WHEN a = pd THEN c ELSE 0 END AS tp,
                     0 AS n_predicted FROM pairs
              UNION ALL
              SELECT pd AS class, 0 AS support, 0 AS tp, c AS n_predicted FROM pairs)
        GROUP BY 1),
pr AS (SELECT class, support, tp,
              coalesce(CAST(tp AS DOUBLE) / nullif(CAST(n_predicted AS DOUBLE), 0), 0.0) AS precision,
              coalesce(CAST(tp AS DOUBLE) / nullif(CAST(support AS DOUBLE), 0), 0.0) AS recall
       FROM per),
rep AS (SELECT class, precision, recall,
               coalesce(CAST(2 AS DOUBLE) * precision * recall / nullif(precision + recall, 0), 0.0) AS f1,
               support, tp
        FROM pr)"""


def _score_row(p: str, model: str) -> str:
    n = "CAST(sum(support) AS DOUBLE)"
    return f"""(WITH {_rule().replace("p AS", "p0 AS", 1)}, p AS (SELECT label, {p} AS predicted FROM p0),{_REPORT}
SELECT '{model}' AS "Model", {R(f'sum(precision * support) / {n}', 6)} AS "Mean Precision",
       {R(f'sum(recall * support) / {n}', 6)} AS "Mean Recall", {R(f'sum(f1 * support) / {n}', 6)} AS "Mean F1-Score",
       {R(f'CAST(sum(tp) AS DOUBLE) / {n}', 6)} AS "Mean Accuracy" FROM rep)"""


def _scenario_knn() -> str:
    from periodfact.plans.learning import FEATURES, MARKERS, SCENARIOS
    rates = ", ".join(f"CAST({lang}_marks AS DOUBLE) * CAST(1000 AS DOUBLE) / CAST(greatest(n_chars, 1) AS DOUBLE) AS {lang}_rate"
                      for lang in MARKERS)
    rows = ", ".join(f"({2025 + i}, {', '.join(f'CAST({v} AS DOUBLE)' for v in r)})" for i, r in enumerate(SCENARIOS))
    dist = " + ".join(f"(d.{c} - s.{c}) * (d.{c} - s.{c})" for c in FEATURES)
    return f"""
WITH m AS (SELECT doc_id, lang, n_chars, {_marks()} FROM documents),
d AS (SELECT m.doc_id, lang, {rates}, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, CAST(coalesce(toxic, 0) AS DOUBLE) AS toxic
      FROM m LEFT JOIN labels l ON m.doc_id = l.doc_id),
s AS (SELECT * FROM (VALUES {rows}) v(yr, {', '.join(FEATURES)})),
nn AS (SELECT yr, lang FROM (SELECT yr, lang, row_number() OVER (PARTITION BY yr ORDER BY {dist}, doc_id) AS rn
                             FROM d CROSS JOIN s) WHERE rn <= 5),
v AS (SELECT yr, lang, count(*) AS c FROM nn GROUP BY 1, 2)
SELECT 'K-Nearest Neighbors' AS "Model", CAST(yr AS INTEGER) AS "Year", lang AS "Prediction"
FROM (SELECT yr, lang, row_number() OVER (PARTITION BY yr ORDER BY c DESC, lang) AS rn FROM v) WHERE rn = 1
"""


def _seed_search() -> str:
    from periodfact.plans.learning import FINAL_TEST_SIZE, RULE_SEEDS
    return f"""
WITH {_rule()},
s AS (SELECT unnest(range({RULE_SEEDS})) AS seed),
h AS (SELECT seed, label, predicted, count(*) OVER (PARTITION BY seed) AS n, row_number() OVER (
          PARTITION BY seed ORDER BY md5(CAST(seed AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
      FROM p CROSS JOIN s),
a AS (SELECT seed, {R('CAST(count(*) FILTER (WHERE label = predicted) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 6)} AS accuracy
      FROM h WHERE rn <= CEIL(n * CAST({FINAL_TEST_SIZE} AS DOUBLE)) GROUP BY 1)
SELECT CAST(seed AS INTEGER) AS seed, accuracy,
       seed = (SELECT min(seed) FROM a WHERE accuracy = (SELECT max(accuracy) FROM a)) AS is_best
FROM a
"""


def _pairwise_votes() -> str:
    from periodfact.plans.learning import LANGS
    pairs = [(a, b) for i, a in enumerate(LANGS) for b in LANGS[i + 1:]]
    cols = ", ".join(f"CASE WHEN {a}_marks >= {b}_marks THEN '{a}' ELSE '{b}' END AS {a}_{b}" for a, b in pairs)
    names = [f"{a}_{b}" for a, b in pairs]
    return f"""
WITH m AS (SELECT doc_id, {_marks()}, 0 AS en_marks FROM documents),
d AS (SELECT doc_id, {cols} FROM m),
v AS (SELECT doc_id, winner, count(*) AS n FROM (SELECT doc_id, unnest([{', '.join(names)}]) AS winner FROM d) GROUP BY ALL),
w AS (SELECT doc_id, winner, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, winner) AS rn FROM v)
SELECT d.*, w.winner AS predicted FROM d JOIN w ON d.doc_id = w.doc_id AND rn = 1
"""


def _scenario_models() -> str:
    from periodfact.plans.learning import FEATURES, SCENARIOS
    rows = ", ".join(f"({2025 + i}, {', '.join(f'CAST({v} AS DOUBLE)' for v in r)})" for i, r in enumerate(SCENARIOS))
    return f"""({_scenario_knn()})
UNION ALL
SELECT 'Marker Rule', CAST(yr AS INTEGER), CASE WHEN fr_rate >= de_rate AND fr_rate >= es_rate AND fr_rate > 0 THEN 'fr'
    WHEN de_rate >= es_rate AND de_rate > 0 THEN 'de' WHEN es_rate > 0 THEN 'es' ELSE 'en' END
FROM (VALUES {rows}) v(yr, {', '.join(FEATURES)})
"""


def _support() -> str:
    from periodfact.plans.learning import FINAL_TEST_SIZE
    return (f"SELECT lang, count(*) AS n_rows, count(*) AS n_listed FROM "
            f"({_holdout('documents', 'doc_id', 'lang', size=FINAL_TEST_SIZE)}) WHERE is_test GROUP BY 1")


def _learning_sql() -> dict[str, str]:
    from periodfact.plans.learning import LANGS
    conf = ", ".join(f"count(*) FILTER (WHERE predicted = '{c}') AS {c}" for c in LANGS)
    n = "CAST(sum(support) AS DOUBLE)"
    return {
        "features_filled": f"""
SELECT d.doc_id, lang, n_chars, CAST(coalesce(quality, 0) AS INTEGER) AS quality,
       CAST(coalesce(toxic, 0) AS INTEGER) AS toxic, {_marks('d.text')},
       CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label_index
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
        "holdout": f"SELECT doc_id, is_test FROM ({_holdout('labels', 'doc_id', 'doc_id')})",
        "oversample_counts": f"""
WITH h AS ({_holdout('labels', 'doc_id', 'doc_id, quality')}),
tr AS (SELECT quality, count(*) AS n FROM h WHERE NOT is_test GROUP BY 1)
SELECT quality, (SELECT max(n) FROM tr) AS n_rows, n AS n_original FROM tr
""",
        "oversample_rows": f"""
WITH h AS ({_holdout('labels', 'doc_id', 'doc_id, quality')}),
tr AS (SELECT doc_id, quality FROM h WHERE NOT is_test),
c AS (SELECT quality, count(*) AS n FROM tr GROUP BY 1),
m AS (SELECT max(n) AS m FROM c)
SELECT doc_id, tr.quality,
       CAST(m // n + CASE WHEN row_number() OVER (PARTITION BY tr.quality
                ORDER BY md5('42|os|' || CAST(doc_id AS VARCHAR)), doc_id) <= m % n
            THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM tr JOIN c ON tr.quality = c.quality CROSS JOIN m
""",
        "knn_predict": f"""
WITH h AS ({_holdout('embeddings', 'vec_id', 'vec_id, embedding, label')}),
te AS (SELECT vec_id, embedding FROM h WHERE is_test),
tr AS (SELECT vec_id, embedding, label FROM h WHERE NOT is_test),
d AS (SELECT te.vec_id AS q, tr.vec_id AS t, tr.label,
             list_reduce(list_transform(range(1, len(te.embedding) + 1),
                 lambda i: (CAST(tr.embedding[i] AS DOUBLE) - CAST(te.embedding[i] AS DOUBLE))
                         * (CAST(tr.embedding[i] AS DOUBLE) - CAST(te.embedding[i] AS DOUBLE))),
                 lambda x, y: x + y) AS dist
      FROM te CROSS JOIN tr),
nn AS (SELECT q, label FROM (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY dist, t) AS rn
                             FROM d) WHERE rn <= 5),
v AS (SELECT q, label, count(*) AS c FROM nn GROUP BY 1, 2)
SELECT q AS vec_id, label AS predicted
FROM (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY c DESC, label ASC) AS rn FROM v)
WHERE rn = 1
""",
        "class_report": f"WITH {_rule()},{_REPORT}\nSELECT class, precision, recall, f1, support FROM rep",
        "model_scores": f"""WITH {_rule()},{_REPORT}
SELECT {R(f'sum(precision * support) / {n}', 6)} AS precision,
       {R(f'sum(recall * support) / {n}', 6)} AS recall,
       {R(f'sum(f1 * support) / {n}', 6)} AS f1,
       {R(f'CAST(sum(tp) AS DOUBLE) / {n}', 6)} AS accuracy
FROM rep""",
        "seed_search_rule": _seed_search(),
        "score_table_rules": _score_row("predicted", "Marker Rule") + " UNION ALL " + _score_row("'en'", "Always English"),
        "scenario_knn": _scenario_knn(),
        "scenario_models": _scenario_models(),
        "pairwise_votes": _pairwise_votes(),
        "forest_support": _support(),
        "svm_support": _support(),
        "confusion": f"WITH {_rule()}\nSELECT label AS actual, {conf} FROM p GROUP BY 1",
    }
