"""Views and reports on small property tables (quirks Q16, Q21, Q22)."""

from __future__ import annotations

import datetime as dt

from propspark.plans import views


def test_top_departments_ties_broken_by_code(spark):
    # Q21: equal averages are ordered by department code, so the top-k is stable.
    muts = spark.createDataFrame([(1, "c1", 10.0), (2, "c2", 10.0), (3, "c3", 30.0), (4, "c4", None)],
                                 "id_mutation long, code_commune string, prix_par_m2_habitable double")
    com = spark.createDataFrame([("c1", "02"), ("c2", "01"), ("c3", "03"), ("c4", "04")],
                                "code_commune string, code_departement string")
    dep = spark.createDataFrame([("01",), ("02",), ("03",), ("04",)], "code_departement string")
    got = [(r.code_departement, r.nb_ventes, r.prix_m2_moyen) for r in views.top_departments(muts, com, dep, k=2).collect()]
    assert got == [("03", 1, 30.0), ("01", 1, 10.0)]


def test_monthly_listings_keeps_non_iso_dates_as_null_month(spark):
    # Q22: a date that is not ISO gives a NULL month; the group is kept and sorts last.
    ann = spark.createDataFrame([("2024-03-01", 100.0), ("2024-03-15", 200.0), ("01/04/2024", 50.0),
                                 ("2024-05-02", 80.0)], "date_publication string, prix double")
    got = [(r.mois, r.nb_annonces, r.prix_moyen) for r in views.monthly_listings(ann, k=6).collect()]
    assert got == [("2024-05", 1, 80.0), ("2024-03", 2, 150.0), (None, 1, 50.0)]


def test_department_stats_groups_carried_columns_and_keeps_empty(spark):
    # Q16: carried dimension columns are grouped on; departments without sales stay with 0.
    dep = spark.createDataFrame([("01", 20000.0, 7.0), ("02", 21000.0, 8.0)],
                                "code_departement string, revenu_median_2021 double, taux_chomage_2023 double")
    com = spark.createDataFrame([("c1", "01"), ("c2", "01"), ("c3", "02")], "code_commune string, code_departement string")
    muts = spark.createDataFrame([(1, "c1", 100.0, 10.0), (2, "c2", 300.0, None)],
                                 "id_mutation long, code_commune string, valeur_fonciere double, prix_par_m2_habitable double")
    got = {r.code_departement: (r.nb_transactions, r.prix_moyen, r.prix_m2_moyen)
           for r in views.department_stats(dep, com, muts).collect()}
    assert got == {"01": (2, 200.0, 10.0), "02": (0, None, None)}


def test_rate_bands_and_lift_split(spark):
    muts = spark.createDataFrame([(dt.date(2021, 1, 5), 100.0), (dt.date(2021, 1, 6), 300.0), (dt.date(2021, 2, 1), 50.0)],
                                 "date_mutation date, valeur_fonciere double")
    ind = spark.createDataFrame([(dt.date(2021, 1, 5), 1.5), (dt.date(2021, 1, 6), None), (dt.date(2021, 2, 1), 3.5)],
                                "date_indicateur date, taux_hors_renegociations double")
    got = {r.tranche_taux: r.nb_ventes for r in views.rate_bands(muts, ind).collect()}
    assert got == {"Taux < 2%": 1, "Taux >= 4%": 1, "Taux 3-4%": 1}
    ann = spark.createDataFrame([("Appartement", 1, 100.0, 50.0), ("Appartement", 0, 80.0, 40.0),
                                 ("Maison", 1, 500.0, 100.0), ("Appartement", 1, 90.0, 0.0)],
                                "type string, ascenseur int, prix double, surface double")
    got = {r.type_immeuble: (r.nb_annonces, r.prix_m2_moyen) for r in views.lift_split(ann).collect()}
    assert got == {"Avec ascenseur": (1, 2.0), "Sans ascenseur": (1, 2.0)}
