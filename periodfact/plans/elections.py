"""The reference's own inputs, declared: indicator files and four election families.

``election_fact(spark, root)`` builds the whole fact from a folder laid out
like the reference's ``data/`` tree: indicators reduced to one row per year
and joined on the year, every election file of every family unpivoted,
tallied through its lookups, zero-filled over the eight orientations, with
shares, residual and winner, one row per (year, family).  Files that are
absent are simply not matched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from periodfact.functions import strip_prefix
from periodfact.operators import BlockLayout, lag_change, measure_gap
from periodfact.operators.contract import Contract, conform
from periodfact.plans.families import Family, Lookup, families_fact
from periodfact.plans.mart import Indicator, indicator_frame, indicator_mart
from periodfact.sinks import save_table
from periodfact.sources import files_exist

# The eight orientations, in the order used for ties and columns.
ORIENTATIONS = ["Extreme gauche", "Gauche radicale", "Gauche", "Ecologie", "Centre", "Droite",
                "Extreme Droite", "Divers"]
# Orientation label variants that differ by more than case or blanks.
ALIASES = {"Gauche Radical": "Gauche radicale"}

# File locations under the data folder.
PRESIDENTIAL = "elections/presidentielles/election_*.csv"
LEGISLATIVE = "elections/legislatives/election_legislative_*.csv"
EUROPEAN = "elections/europeens/election_europeenne_*.csv"
REGIONAL = "elections/regionales/election_regionale_*.csv"
CANDIDATES = "candidats/candidats_*.csv"
PARTIES = "parti-politique/partis.csv"
EURO_LISTS = "parti-politique/europeens/partis-euro.csv"
YEAR_IN_NAME = r"_(\d{4})\.csv$"
TOTAL = "Exprimes"

# Block geometry (start column, step, field offsets) per family
# and year group; None is "every other year".
PRESIDENTIAL_LAYOUTS = [(None, BlockLayout(16, 6, {"last": 0, "first": 1, "votes": 2}, key=("last",)))]
LEGISLATIVE_LAYOUTS = [(None, BlockLayout(15, 4, {"code": 0, "votes": 1}, key=("code",)))]
EUROPEAN_LAYOUTS = [
    ([2004], BlockLayout(9, 4, {"code": 1, "votes": 3}, stop="first_missing", key=("code",))),
    ([1994, 1999], BlockLayout(14, 5, {"code": 1, "votes": 3}, stop="first_missing", key=("code",))),
    ([2019], BlockLayout(16, 7, {"code": 0, "votes": 3}, key=("code",))),
    (None, BlockLayout(16, 7, {"code": 1, "votes": 3}, stop="first_missing", key=("code",))),
]
_STRIP = {"code": strip_prefix}
REGIONAL_LAYOUTS = [
    ([2004], BlockLayout(15, 5, {"code": 0, "votes": 2}, transforms=_STRIP, key=("code",))),
    ([2010], BlockLayout(15, 6, {"code": 0, "votes": 3}, transforms=_STRIP, key=("code",))),
    ([1998], BlockLayout(13, 5, {"code": 0, "votes": 2}, transforms=_STRIP, key=("code",))),
    (None, BlockLayout(16, 8, {"code": 0, "votes": 4}, transforms=_STRIP, key=("code",))),
]

# The model features (fact columns) and the what-if scenario rows.
FEATURES = ["moyenne_smic_horaire_brut", "moyenne_ipc", "moyenne_pouvoir_achat_unite_conso",
            "moyenne_pouvoir_achat_revenu_brute", "moyenne_ensemble_chomage",
            "preoccupation_chomage", "preoccupation_racisme", "nombre_incivilite"]
SCENARIOS = [[450, 350, 3, 2, 5, 3, 5, 500000],
             [350, 301, 0.3, -0.1, 10, 15, 25, 8000000],
             [275, 250, 10, 8.2, 8, 13, 2, 8500000]]

# The stored fact table, its columns in order and their types; each column's name in the built fact.
_MEASURE = "decimal(10,2)"
FACT_TABLE = Contract([
    ("Annee", "int"), ("Orientation_politique_gagnante", "varchar(255)"),
    *[(name, _MEASURE) for name in (
        "total_vote_extreme_gauche", "total_vote_gauche_radicale", "total_vote_gauche", "total_vote_ecologie",
        "total_vote_centre", "total_vote_droite", "total_vote_extreme_droite", "total_vote_divers",
        "moyenne_smic_horaire_brut", "moyenne_ipc", "moyenne_pouvoir_achat_unite_conso",
        "moyenne_pouvoir_achat_revenu_brute", "moyenne_ensemble_chomage", "taux_insecurite_femmes",
        "taux_insecurite_hommes", "population_etrangere", "population_immigres", "population_totale_etrangere",
        "preoccupation_terrorisme", "preoccupation_chomage", "preoccupation_pauvrete", "preoccupation_sante",
        "preoccupation_deliquance", "preoccupation_racisme", "preoccupation_ecologie",
        "preoccupation_securite_routiere", "nombre_incivilite")]])
FACT_SOURCES = {"Annee": "period", "Orientation_politique_gagnante": "winner",
                **{f"total_vote_{name}": f"share_{name}" for name in (
                    "extreme_gauche", "gauche_radicale", "gauche", "ecologie", "centre", "droite", "extreme_droite", "divers")}}
#: The concern file's measures, in the order of its columns.
CONCERNS = [name for name, _ in FACT_TABLE.columns if name.startswith("preoccupation_")]

# Indicator files and the header names of their measures.
INDICATORS = {
    "base": ("indicateurs/indicateur_evoluation_smic_ipc.csv",
             {"moyenne_smic_horaire_brut": "Smic horaire brut",
              "moyenne_ipc": "Prix (y compris tabac)1"}, {}),
    "purchasing": ("indicateurs/indicateur_pouvoir_achat.csv",
                   {"moyenne_pouvoir_achat_unite_conso": "Pouvoir d'achat par unite de consommation",
                    "moyenne_pouvoir_achat_revenu_brute": "Pouvoir d'achat du revenu disponible brut"},
                   {}),
    "unemployment_sex": ("indicateurs/indicateur_taux_chomage_sexe.csv",
                         {"moyenne_chomage_femmes": "Femmes", "moyenne_chomage_hommes": "Hommes"}, {}),
    "unemployment": ("indicateurs/indicateur_taux_chomage_age.csv",
                     {"moyenne_chomage_15_24": "15-24 ans", "moyenne_chomage_25_49": "25-49 ans",
                      "moyenne_chomage_50_plus": "50 ans ou plus",
                      "moyenne_ensemble_chomage": "Ensemble"}, {}),
    "insecurity": ("indicateurs/indicateur_insecurite.csv",
                   {"taux_insecurite_femmes": "Femmes", "taux_insecurite_hommes": "Hommes"},
                   {"keep": ("Tranche age", "Ensemble")}),
    "population": ("indicateurs/indicateur_population_etrangere.csv",
                   {"population_etrangere": "Etrangers", "population_immigres": "Immigres",
                    "population_totale_etrangere": "Population totale"}, {"reduce": "none"}),
    "concern": ("indicateurs/indicateur_preocuppation.csv", None,
                {"reduce": "none", "optional": True, "names": CONCERNS}),
    "incidents": ("indicateurs/indicateur_nombre_incivilite.csv", None,
                  {"reduce": "row_total", "period_code": (2, 4), "out": "nombre_incivilite",
                   "optional": True}),
}


def _family(root: str, name: str, pattern: str, layouts, item, lookups, n_cols: int | None,
            winner: str = "category") -> Family:
    return Family(name, f"{root}/{pattern}", YEAR_IN_NAME, n_cols=n_cols, total_col=TOTAL,
                  layouts=layouts, item=item, lookups=lookups, winner=winner)


def election_families(root: str, n_cols: int | None = None) -> list[Family]:
    """The four families; each file's own header gives its width."""
    parties = Lookup(f"{root}/{PARTIES}", key=[0], value=1, n_cols=2)
    return [
        _family(root, "presidential", PRESIDENTIAL, PRESIDENTIAL_LAYOUTS, ["last", "first"],
                [Lookup(f"{root}/{CANDIDATES}", key=[0, 1], value=2, n_cols=3,
                        period_pattern=YEAR_IN_NAME), parties], n_cols),
        _family(root, "legislative", LEGISLATIVE, LEGISLATIVE_LAYOUTS, ["code"], [parties], n_cols),
        _family(root, "european", EUROPEAN, EUROPEAN_LAYOUTS, ["code"],
                [Lookup(f"{root}/{EURO_LISTS}", key=[0], value=1, n_cols=2)], n_cols,
                winner="item"),
        _family(root, "regional", REGIONAL, REGIONAL_LAYOUTS, ["code"], [parties], n_cols),
    ]


def indicators(spark: SparkSession, root: str) -> DataFrame:
    specs = {k: Indicator(f"{root}/{path}", measures, **extra)
             for k, (path, measures, extra) in INDICATORS.items()}
    base = specs.pop("base")
    return indicator_mart(spark, base, list(specs.values()))


def election_fact(spark: SparkSession, root: str, n_cols: int | None = None,
                  families: list[Family] | None = None) -> DataFrame:
    """One fact row per (year, family) with the year's indicators."""
    mart = indicators(spark, root)
    totals = [c for c in mart.columns if c == "nombre_incivilite"]   # counts: wide decimal
    cols = [c for c in mart.columns if c != "period" and c not in totals]
    return families_fact(spark, families or election_families(root, n_cols), ORIENTATIONS,
                         mart=mart, aliases=ALIASES, indicator_cols=cols, total_cols=totals)


def stored_fact(fact: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """The fact with exactly the columns and types of the stored table; a column that the fact lacks fails.

    ``rejects`` counts, while the table is written, the values that their type
    can't hold (a year's incidents beyond 99,999,999.99, say).
    """
    return conform(fact, FACT_TABLE, FACT_SOURCES, rejects=rejects)


def learn_from_fact(spark: SparkSession, fact: DataFrame, seed: int = 42, test_size: float = 0.4,
                    absent: Sequence[str] = ()):
    """Score table and scenario predictions for the winner, from the fact's indicators.

    A feature that the fact lacks is an error; ``absent`` names those that are
    0 because their source file is known to be missing.
    """
    from periodfact.plans.learning import model_report
    return model_report(spark, _learnable(fact, absent), "row_key", "winner", FEATURES, seed=seed, test_size=test_size,
                        scenarios=SCENARIOS)


def learn_by_best_seed(spark: SparkSession, fact: DataFrame, seeds: Sequence[int] = tuple(range(50)), absent: Sequence[str] = ()) -> dict:
    """The reference's whole learning run on the fact: see :func:`periodfact.plans.learning.learning_protocol`."""
    from periodfact.plans.learning import learning_protocol
    return learning_protocol(spark, _learnable(fact, absent), "row_key", "winner", FEATURES, seeds, SCENARIOS)


def _learnable(fact: DataFrame, absent: Sequence[str]) -> DataFrame:
    lacking = [c for c in FEATURES if c not in fact.columns and c not in absent]
    if lacking:
        raise ValueError(f"features that the fact lacks: {lacking}")
    data = fact.withColumns({c: F.col(c).cast("double") if c in fact.columns else F.lit(0.0) for c in FEATURES})
    return data.withColumn("row_key", F.concat_ws("|", "period", "family")).where(F.col("winner").isNotNull())


#: The indicator tables that are stored beside the fact.
INDICATOR_TABLES = {"taux_chomage": "unemployment", "pouvoir_achat": "purchasing", "infractions_criminalite": "incidents",
                    "population_etrangere": "population", "insecurite_france": "insecurity"}


def indicator_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Each stored indicator table, and ``evolution_smic_inflation``: wage and price index, their gap and their yearly changes.

    A file that is absent has no table.
    """
    specs = {k: Indicator(f"{root}/{path}", measures, **extra) for k, (path, measures, extra) in INDICATORS.items()}
    found = {name: indicator_frame(spark, specs[k]) for name, k in INDICATOR_TABLES.items() if files_exist(spark, specs[k].path)}
    if files_exist(spark, specs["base"].path):
        wage, prices = specs["base"].measures
        gap = measure_gap(indicator_frame(spark, specs["base"]), wage, prices, "resultat_soustraction")
        found["evolution_smic_inflation"] = lag_change(gap, {"smic_evolution": wage, "prix_conso_evolution": prices}, per_period=True)
    return found


def save_indicator_tables(spark: SparkSession, root: str, target_dir: str) -> list[str]:
    """K1 for each of :func:`indicator_tables`; the names of the tables written."""
    tables = indicator_tables(spark, root)
    for name, table in tables.items():
        save_table(table, f"{target_dir.rstrip('/')}/{name}")
    return sorted(tables)
