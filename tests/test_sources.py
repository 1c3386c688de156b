"""File sources and sinks on synthetic files written to a temp folder."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from propspark.constants import LISTING_PII_KEYS, RAW_SALES_COLUMNS
from propspark.operators import clean
from propspark.sources import files, listings


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8") as f:
        f.write(("﻿" if bom else "") + text)


def _sales_csv(rows, cols=RAW_SALES_COLUMNS):
    lines = [",".join(cols)]
    for r in rows:
        lines.append(",".join(r.get(c, "") or "" for c in cols))
    return "\n".join(lines) + "\n"


ROW = {"date_mutation": "2021-03-01", "nature_mutation": "Vente", "valeur_fonciere": "250000",
       "type_local": "Maison", "surface_reelle_bati": "100", "longitude": "2.35", "latitude": "48.85",
       "code_departement": "75", "code_commune": "75056"}


def test_read_raw_sales_many_files_and_empty_partition(spark, tmp_dir):
    d75, d13, d01 = (os.path.join(tmp_dir, x) for x in ("75.csv", "13.csv", "01.csv"))
    _write(d75, _sales_csv([ROW, ROW]))
    _write(d13, _sales_csv([dict(ROW, code_departement="13", code_commune="13055")]))
    _write(d01, "")                                            # empty file
    raw = files.read_raw_sales(spark, [d75, d13, d01])
    assert raw.count() == 3
    assert raw.schema["valeur_fonciere"].dataType.simpleString() == "string"
    sales = clean.clean_sales(raw, partition_key=None)
    assert sales.count() == 1            # same 5-column key within a file and across files
    per_file = clean.clean_sales(raw, partition_key="_source_file")
    assert per_file.count() == 2         # per-file dedup, as the source pipeline does
    expected = spark.createDataFrame([("75",), ("13",), ("01",)], "code_departement string")
    missing = [r.code_departement for r in files.empty_partitions(expected, raw, "code_departement").collect()]
    assert missing == ["01"]


def test_read_raw_sales_rejects_reordered_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.csv")
    cols = list(RAW_SALES_COLUMNS)
    cols[0], cols[1] = cols[1], cols[0]
    _write(p, _sales_csv([ROW], cols))
    with pytest.raises(Exception):
        files.read_raw_sales(spark, [p]).collect()


def test_read_series_with_bom_and_census_with_preamble(spark, tmp_dir):
    s = os.path.join(tmp_dir, "rates.csv")
    _write(s, '"Category";"Taux hors renégociations"\n"janv. 2015";"2,49"\n"févr. 2015";"2,3"\n', bom=True)
    df = files.read_series(spark, s)
    assert df.columns[0] == "Category" and df.count() == 2
    c = os.path.join(tmp_dir, "census.csv")
    _write(c, 'Titre du fichier\nSource: recensement\nCode;Libellé;Nb de ménages 2021;Médiane\n'
              '01;Ain;280000;23000\n2A;Corse-du-Sud;70000;N/A - résultat non disponible\n971;Guadeloupe;;19000\n', bom=True)
    census = files.read_census(spark, c, ["code", "libelle", "menages", "mediane"])
    rows = {r.code: r for r in census.collect()}
    assert set(rows) == {"01", "2A", "971"}
    assert rows["2A"].mediane is None


def test_write_table_and_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(2020, "a", 1.5), (2021, "b", 2.5)], "annee int, k string, v double")
    out = os.path.join(tmp_dir, "t")
    files.write_table(df, out, partition_by=["annee"])
    back = spark.read.parquet(out)
    assert sorted((r.annee, r.k) for r in back.collect()) == [(2020, "a"), (2021, "b")]
    assert back.filter("annee = 2021").count() == 1          # partition pruning path
    csv = os.path.join(tmp_dir, "c")
    files.write_csv(df, csv)
    assert spark.read.option("header", True).option("sep", ";").csv(csv).count() == 2


def test_read_listings_json_array_and_types(spark, tmp_dir):
    recs = [
        {"id": "A1", "prix": 250000, "honoraires": {"value": 5000}, "surface": 80.0, "ascenseur": True,
         "charges_annuelles": "1200", "image_urls": ["u1", ""], "date_publication": "2024-03-01"},
        {"id": "A1", "prix": {"value": 0, "commission": 8000}, "surface": 0.0, "ascenseur": None,
         "charges_annuelles": "", "date_publication": "01/03/2024"},
        {"id": "B2", "prix": None, "charges_annuelles": "abc"},
    ]
    p = os.path.join(tmp_dir, "listings.json")
    _write(p, json.dumps(recs))
    df = listings.type_listing(listings.read_listings(spark, p)).orderBy("ingest_seq").collect()
    assert [r.prix for r in df] == [250000.0, 8000.0, None]
    assert [r.honoraires for r in df] == [5000.0, None, None]
    assert [r.ascenseur for r in df] == [1, 0, 0]
    assert [r.charges_annuelles for r in df] == [1200.0, None, None]


def test_lift_flag_keeps_its_json_type(spark, tmp_dir):
    """number, text, boolean and null forms, from a file and a payload."""
    values = [0, "0", False, "false", "", None, 1, "oui", True, 0.0, -0.5, [], [0], {}, {"value": 0}]
    p = os.path.join(tmp_dir, "lifts.json")
    _write(p, json.dumps([{"id": str(k), "ascenseur": v} for k, v in enumerate(values)] + [{"id": "missing"}]))
    want = {str(k): int(bool(v)) for k, v in enumerate(values)} | {"missing": 0}
    assert {r.id: r.ascenseur for r in listings.type_listing(listings.read_listings(spark, p)).collect()} == want
    rows = [(json.dumps({"Bien_Reference": str(k), "Bien_Ascenseur": v}),) for k, v in enumerate(values)]
    rows.append((json.dumps({"Bien_Reference": "missing"}),))
    records = listings.payload_to_listing(spark.createDataFrame(rows, "payload string"))
    assert {r.id: r.ascenseur for r in listings.type_listing(records).collect()} == want


def test_payload_to_listing_drops_personal_data(spark):
    payload = {"Bien_Reference": "R1", "Bien_Prix": {"value": 100}, "Bien_Conseiller_Nom": "X",
               "Bien_Conseiller_Email": "x@y", "Image_0": "i0", "Image_1": "", "Bien_Image_1": "main"}
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    out = listings.payload_to_listing(df)
    r = out.first()
    assert r.id == "R1" and r.url.endswith("R1") and r.image_urls == ["i0"] and r.image_principale == "main"
    assert r.prix == '{"value":100}'
    assert not set(LISTING_PII_KEYS) & set(out.columns)
    assert not any("Conseiller" in c for c in out.columns)
    assert out.select(F.lit(1)).count() == 1


def test_read_departments_prunes_extra_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "departements.csv")
    _write(p, "code_departement,nom_departement,code_region,nom_region\n01,Ain,84,ARA\n2A,Corse-du-Sud,94,COR\n971,Guadeloupe,1,GUA\n")
    df = files.read_departments(spark, p)
    assert df.columns == ["code_departement", "nom_departement"]
    assert sorted(r.code_departement for r in df.collect()) == ["01", "2A", "971"]


def test_read_listings_json_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "drop.jsonl")
    _write(p, "\n".join(json.dumps(r) for r in [{"id": "A", "prix": 10}, {"id": "B", "prix": {"value": 7}}]) + "\n")
    df = listings.type_listing(listings.read_listings(spark, p, multiline=False))
    assert sorted((r.id, r.prix) for r in df.collect()) == [("A", 10.0), ("B", 7.0)]


def test_macro_chain_from_files(spark, tmp_dir):
    """S3 + S4 + F5 + F6 + P7 + J1 on files in the source formats."""
    from propspark.operators import macro
    labels = ["déc. 2014", "janv. 2015", "févr. 2015", "mars 2015"]
    prod = os.path.join(tmp_dir, "prod.csv")
    _write(prod, '"Category";"Crédit total";"Crédits hors renégociations";"Renégociés"\n' +
           "".join(f'"{lab}";"1{i},5";"{i + 7},{i}";""\n' for i, lab in enumerate(labels)), bom=True)
    rate = os.path.join(tmp_dir, "rate.csv")
    _write(rate, '"Category";"Taux"\n' + "".join(f'"{lab}";"2,{i}9"\n' for i, lab in enumerate(labels)), bom=True)
    infl = os.path.join(tmp_dir, "infl.csv")
    _write(infl, "Date,IPC\n2015-04,1.7\n2015-03,0.2\n2015-02,-0.3\n2015-01,-0.4\n2014-12,0.1\n")
    s1 = macro.typed_series(files.read_series(spark, prod), "Category", ["Crédits hors renégociations"])
    s2 = macro.typed_series(files.read_series(spark, rate), "Category", ["Taux"])
    s3 = macro.typed_series(files.read_series(spark, infl, sep=","), "Date", ["IPC"], label_format="yyyy-MM")
    rows = macro.macro_chain([s1, s2, s3]).orderBy("Date").collect()
    import datetime as dt
    assert [r.Date for r in rows] == [dt.date(2015, 1, 1), dt.date(2015, 2, 1), dt.date(2015, 3, 1)]
    assert [(r["Crédits hors renégociations"], r.Taux, r.IPC) for r in rows] == [
        (8.1, 2.19, -0.4), (9.2, 2.29, -0.3), (10.3, 2.39, 0.2)]


def test_empty_and_header_only_files_are_reported(spark, tmp_dir):
    cols = files.RAW_SALES_COLUMNS
    head = ",".join(cols) + "\n"
    for name, text in (("01.csv", head + "x" + "," * (len(cols) - 1) + "\n"), ("02 bis.csv", head), ("03.csv", "")):
        _write(os.path.join(tmp_dir, name), text)
    paths = [os.path.join(tmp_dir, "*.csv")]
    out = files.empty_files(spark, paths, files.read_raw_sales(spark, paths)).collect()
    assert sorted(r.path.rsplit("/", 1)[1].replace("%20", " ") for r in out) == ["02 bis.csv", "03.csv"]


def test_files_with_rows_and_escaped_names_are_not_empty(spark, tmp_dir):
    cols = files.RAW_SALES_COLUMNS
    head = ",".join(cols) + "\n"
    for name in ("01 a.csv", "02 é%.csv"):
        _write(os.path.join(tmp_dir, name), head + "x" + "," * (len(cols) - 1) + "\n")
    _write(os.path.join(tmp_dir, "03 b.csv"), head)
    out = files.empty_files(spark, tmp_dir, files.read_raw_sales(spark, tmp_dir)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in out] == ["03%20b.csv"]
