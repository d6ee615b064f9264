"""The reference's two halves on small files of its shapes: indicator mart and family facts."""

import os

import pytest

from periodfact.operators import BlockLayout
from periodfact.plans.families import Family, Lookup, families_fact
from periodfact.plans.mart import Indicator, indicator_mart

CATS = ["Extreme gauche", "Gauche", "Ecologie", "Centre", "Droite", "Divers"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def files(scratch):
    d = scratch
    # indicators: quarterly rows, decimal comma, space-grouped thousands, an age band with a blank
    write(f"{d}/ind/wage.csv", "Annee;Trimestre;Smic horaire brut;Prix (y compris tabac)1\n"
          "2022;T2;106.79;102.34\n2022;T1;104.58;102.11\n2017;T1;100.00;100.00\n")
    write(f"{d}/ind/insecurite.csv", "Annee;Femmes;Hommes;Tranche age\n"
          "2017;16,0;9,2;14-29 ans\n2017;13,7;7,9;Ensemble \n")
    write(f"{d}/ind/pop.csv", 'Annee;Etrangers;Immigres;"Population totale\n2022;5 315;7 007;67 843\n')
    write(f"{d}/ind/incidents.csv", "Annee;a;b\n_2017_01;1;2\n_2017_02;3;\n_2022_01;5;5\n")
    # presidential: blocks of (last, first, votes) from column 3; header drift in candidate lists
    write(f"{d}/pres/pres_2017.csv", "area;Inscrits;Exprimes;Nom;Prenom;Voix;Nom;Prenom;Voix\n"
          "a1;50;40;Durand;Ana;10;Martin;Luc;25\na2;30;20;Durand;Ana;15;Martin;Luc;5\n")
    write(f"{d}/pres/pres_2022.csv", "area;Inscrits;Exprimes;Nom;Prenom;Voix;Nom;Prenom;Voix\n"
          "a1;50;45;Petit;Zoe;20;Durand;Ana;20\n")
    write(f"{d}/cand/cand_2017.csv", "Nom;Prenom;Parti\ndurand;ana;LO\nmartin;luc;DV\n")
    write(f"{d}/cand/cand_2022.csv", "Nom;Prénom;Parti\npetit;zoe;ECO\ndurand;ana;LO\n")
    write(f"{d}/parties.csv", "Nom du parti;Orientation politique\nLO;Extreme Gauche\n"
          "DV;Ecologie\nECO;Ecologie\nDV;Divers\n\n\n")
    # european: list label at offset 1 in 2019 files, votes at offset 2; winner by biggest list
    write(f"{d}/euro/euro_2019.csv", "area;Exprimes;Num;Libelle;Voix;Num;Libelle;Voix\n"
          "a1;30;1;L-GAU;12;2;L-DRO;12\na2;10;1;L-GAU;1;2;L-CEN;9\n")
    write(f"{d}/lists.csv", "Libelle parti;Orientation Politique\nL-GAU;Gauche\nL-DRO;Droite\nL-CEN;Centre\n")
    return d


def test_indicator_mart(spark, files):
    d = files
    base = Indicator(f"{d}/ind/wage.csv", {"wage": "Smic horaire brut", "prices": "Prix (y compris tabac)1"})
    mart = indicator_mart(spark, base, [
        Indicator(f"{d}/ind/insecurite.csv", {"insec_women": "Femmes", "insec_men": "Hommes"},
                  keep=("Tranche age", "Ensemble")),
        Indicator(f"{d}/ind/pop.csv", {"foreign": "Etrangers", "total_pop": "Population totale"},
                  reduce="none"),
        Indicator(f"{d}/ind/incidents.csv", {"a": "a", "b": "b"}, reduce="sum", period_code=(2, 4)),
    ])
    rows = {r.period: r for r in mart.collect()}
    assert set(rows) == {2017, 2022}
    assert (rows[2022].wage, rows[2022].prices) == (105.69, 102.23)
    assert (rows[2017].insec_women, rows[2017].insec_men) == (13.7, 7.9)
    assert (rows[2022].foreign, rows[2022].total_pop, rows[2017].foreign) == (5315.0, 67843.0, None)
    assert (rows[2017].a, rows[2017].b, rows[2022].a) == (4.0, 2.0, 5.0)


def test_families_fact(spark, files):
    d = files
    pres = Family("presidential", f"{d}/pres/pres_*.csv", r"pres_(\d{4})\.csv$", n_cols=9, total_col=2,
                  layouts=[(None, BlockLayout(3, 3, {"last": 0, "first": 1, "votes": 2},
                                              key=("last",)))],
                  item=["last", "first"],
                  lookups=[Lookup(f"{d}/cand/cand_*.csv", key=[0, 1], value=2, n_cols=3,
                                  period_pattern=r"cand_(\d{4})\.csv$"),
                           Lookup(f"{d}/parties.csv", key=[0], value=1, n_cols=2)])
    euro = Family("european", f"{d}/euro/euro_*.csv", r"euro_(\d{4})\.csv$", n_cols=8, total_col=1,
                  layouts=[([2019], BlockLayout(2, 3, {"label": 1, "votes": 2}, key=("label",)))],
                  item=["label"], lookups=[Lookup(f"{d}/lists.csv", key=[0], value=1, n_cols=2)],
                  winner="item")
    fact = families_fact(spark, [pres, euro], CATS)
    rows = {(r.period, r.family): r for r in fact.collect()}
    assert set(rows) == {(2017, "presidential"), (2022, "presidential"), (2019, "european")}
    p17 = rows[(2017, "presidential")]
    # Durand 25 -> LO -> "Extreme Gauche" (case variant); Martin 30 -> DV -> first match Ecologie
    assert p17.winner == "Ecologie"
    assert (float(p17.share_extreme_gauche), float(p17.share_ecologie)) == (41.67, 50.0)
    assert float(p17.share_residual) == 8.33 and float(p17.total) == 60.0
    p22 = rows[(2022, "presidential")]
    # tie 20 / 20: the earlier listed category wins
    assert p22.winner == "Extreme gauche"
    e19 = rows[(2019, "european")]
    # biggest list: L-GAU 13 -> Gauche (not the biggest category)
    assert e19.winner == "Gauche"
    assert (float(e19.share_gauche), float(e19.share_droite), float(e19.share_centre)) == (32.5, 30.0, 22.5)
