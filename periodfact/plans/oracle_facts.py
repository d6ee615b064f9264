"""DuckDB SQL of the plans in :mod:`periodfact.plans.facts`."""

from __future__ import annotations

from periodfact.plans import oracle as O
from periodfact.plans.elections import FACT_TABLE
from periodfact.plans.facts import _LINE_COUNTS, _MEANS, _ORDER_COUNTS

_SHARES = [f"share_{c}" for c in O.CATS] + ["share_residual"]


def _stored(extra: str = "") -> str:
    return ", ".join(f"{O.D(c)} AS {c}" for c in _SHARES) + f", {O.D('total', 20)} AS total{extra}"


def _chain(codes: str = "TRUE") -> str:
    """The lineitem family's tally; ``codes`` tells which codes have a category."""
    bt = O._BT.replace("WHERE p_brand IS NOT NULL", f"WHERE p_brand IS NOT NULL AND {codes}")
    return ",\n".join([O._IT, O._PK, O._CT, bt])


LAYOUTS_FACT = f"""
WITH {_chain()},
{O._CAT},
{O._zero_fill()},
{O._TOTAL},
sh AS (SELECT z.period, total, {O._shares('total')} FROM z LEFT JOIN t ON z.period = t.period),
{O._winner()}
SELECT sh.period, 'orders' AS family, w.winner, {_stored()} FROM sh LEFT JOIN w ON sh.period = w.period
"""

LAYOUT_REPORT = f"""
SELECT period, 11 AS header_width, count(*) AS n_rows, count(*) FILTER (used < 11) AS n_short,
       count(*) FILTER (used <= 11 AND (used - 3) % 2 = 1) AS n_partial, count(*) FILTER (used > 11) AS n_surplus_rows,
       CAST(coalesce(sum(used - 11) FILTER (used > 11), 0) AS BIGINT) AS n_surplus_cells
FROM (SELECT {O.P('o_orderdate')} AS period,
             3 + 2 * (1 + o_orderkey % 5) - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS used FROM orders)
GROUP BY 1
"""


def _misses(policy: str, codes: str) -> str:
    category = "CASE WHEN bt.p_type IS NULL THEN 'ABSENT' ELSE bt.p_type END" if policy == "bucket" else "bt.p_type"
    total = "t.total - coalesce(m.unmatched_votes, 0)" if policy == "drop" else "t.total"
    return f"""
WITH {_chain(codes)},
cat AS (SELECT period, {category} AS category, sum(votes) AS votes
        FROM ct LEFT JOIN bt ON ct.code = bt.p_brand GROUP BY 1, 2),
m AS (SELECT period, count(*) AS unmatched_items, sum(votes) AS unmatched_votes
      FROM it LEFT JOIN pk ON it.item = pk.p_partkey LEFT JOIN bt ON pk.p_brand = bt.p_brand WHERE bt.p_type IS NULL GROUP BY 1),
{O._zero_fill()},
{O._TOTAL},
y AS (SELECT z.*, {total} AS total, coalesce(m.unmatched_items, 0) AS unmatched_items,
             coalesce(m.unmatched_votes, 0) AS unmatched_votes
      FROM z LEFT JOIN t ON z.period = t.period LEFT JOIN m ON z.period = m.period),
sh AS (SELECT period, total, unmatched_items, unmatched_votes, {O._shares('total')} FROM y),
{O._winner()}
SELECT sh.period, w.winner, {_stored(", unmatched_items, " + O.D('unmatched_votes', 20) + " AS unmatched_votes")}
FROM sh LEFT JOIN w ON sh.period = w.period
"""


def _stored_fact() -> str:
    votes = dict(zip([n for n in FACT_TABLE.names if n.startswith("total_vote_")], _SHARES))
    fit = "TRY_CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DECIMAL(10,2))"
    cols = ["sh.period AS Annee", "w.winner AS Orientation_politique_gagnante"]
    cols += [f"{fit.format(x=votes.get(n, n))} AS {n}" for n in FACT_TABLE.names[2:]]

    def counts(which):
        return ", ".join(f"count(*) FILTER ({c} = '{v}') AS {out}" for out, (c, v) in which.items())

    means = ", ".join(f"{O.R(O.EM(c))} AS {out}" for out, c in _MEANS.items())
    return f"""
WITH {_chain()},
{O._CAT},
{O._zero_fill()},
{O._TOTAL},
sh AS (SELECT z.period, {O._shares('total')} FROM z LEFT JOIN t ON z.period = t.period),
{O._winner()},
li AS (SELECT {O.P('l_shipdate')} AS period, {means}, {counts(_LINE_COUNTS)}, count(*) AS population_totale_etrangere,
              {O.ES('l_extendedprice')} AS nombre_incivilite FROM lineitem GROUP BY 1),
o AS (SELECT {O.P('o_orderdate')} AS period, {counts(_ORDER_COUNTS)} FROM orders GROUP BY 1),
mn AS (SELECT period, avg_totalprice AS moyenne_ensemble_chomage FROM {O._YEARLY_PRICE} p)
SELECT {', '.join(cols)}
FROM sh LEFT JOIN w ON sh.period = w.period LEFT JOIN li ON sh.period = li.period LEFT JOIN o ON sh.period = o.period
LEFT JOIN mn ON sh.period = mn.period
"""


_FOUR = "CAST(round(CAST({x} AS DECIMAL(38,8)), 4) AS DOUBLE)"
SUM_DISCOUNTED = f"""
SELECT {O.P('l_shipdate')} AS period, {_FOUR.format(x='sum(p * d)')} AS discounted, {_FOUR.format(x='sum(p * (1 - d) * (1 + t))')} AS charged
FROM (SELECT l_shipdate, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t FROM lineitem)
GROUP BY 1
"""


def _changed(c: str) -> str:
    return O.R(f"({c} - lag({c}) OVER w) / nullif(lag({c}) OVER w, 0) * 100")


EVOLUTION = f"""
WITH m AS (SELECT {O.P('l_shipdate')} AS period, {O.R(O.EM('l_extendedprice'))} AS avg_price, {O.R(O.EM('l_quantity'))} AS avg_quantity
           FROM lineitem GROUP BY 1)
SELECT period, avg_price, avg_quantity, avg_price - avg_quantity AS gap, {_changed('avg_price')} AS price_change,
       {_changed('avg_quantity')} AS quantity_change
FROM m WINDOW w AS (ORDER BY period)
"""


def oracle_sql() -> dict[str, str]:
    known = "p_brand < 'Brand#3'"
    return {"wide_files_layouts_fact": LAYOUTS_FACT, "wide_files_layout_report": LAYOUT_REPORT,
            "fact_unmatched_bucket": _misses("bucket", known), "fact_unmatched_drop": _misses("drop", known),
            "fact_unmatched_error": _misses("error", "TRUE"), "stored_fact_table": _stored_fact(),
            "fact_appended_twice": O.FAMILY_UNION, "sum_discounted_by_period": SUM_DISCOUNTED,
            "evolution_table": EVOLUTION}
