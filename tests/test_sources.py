"""File sources: sensor metadata CSV, logger inventory, isotopes, templates."""

import os

from pyspark.sql import functions as F

from wellspring.operators import quality as Q
from wellspring.plans import composites as C
from wellspring.session import scratch_path
from wellspring.sources import readers as SR
from wellspring.sources import sinks as K


def _local(path):
    """Scratch paths may carry a 'file:' scheme; Python's open() needs none."""
    return path[len("file:"):] if path.startswith("file:") else path


def _write(path, text):
    path = _local(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_sensor_metadata_csv(spark):
    root = scratch_path(spark, "t-meta")
    _write(os.path.join(root, "meta.csv"),
           "galerie,brunnen_nummer,dn,einbau_pumpe,einbau_messkette,filteroberkante_muGOK,"
           "filterunterkante_muGOK,sensor_id, sensor_endnummer,einbau_sensor_muGOK\n"
           "K,9,400,oben,unten,21,27,1000018,8,21.5\n")
    r = SR.read_sensor_metadata(spark, os.path.join(root, "meta.csv")).first()
    assert (r.galerie, r.brunnen_nummer, r.sensor_endnummer, r.einbau_sensor_muGOK) == ("K", 9, 8, 21.5)


def test_logger_inventory_and_newest(spark):
    root = scratch_path(spark, "t-sftp")
    for rel in ("K09/LF_4182018-2023-05-10-1100.csv", "K10/4182001_2023-05-11-1100.csv", "K10/readme.csv"):
        _write(os.path.join(root, rel), "Geraet,DatumUhrzeit,Leitfaehigkeit,Temperatur\n")
    files = SR.list_files(spark, root, "*.csv")
    inv = SR.logger_inventory(files, root)
    rows = {r.sftp_path: r for r in inv.collect()}
    assert rows["K09/LF_4182018-2023-05-10-1100.csv"].sensor_id == 4182018
    assert rows["K10/4182001_2023-05-11-1100.csv"].brunnen_nummer == 10
    bad = Q.bad_logger_names(inv).collect()
    assert [r.sftp_path for r in bad] == ["K10/readme.csv"]
    assert SR.newest_files(files).count() >= 1


def test_isotope_file(spark):
    root = scratch_path(spark, "t-iso")
    _write(os.path.join(root, "iso.csv"),
           "lab_id;site_id;sampling_date;fuk_masl;x2h;x18o;cond_field\n"
           "L1;S1;05.03.2021;12.5;<1.5;-8.2;410\n"
           "L2;S2;06.03.2021;13.0;-60.1;-8.4;\n")
    long = C.isotopes_long(SR.read_isotopes(spark, os.path.join(root, "iso.csv")), "crew_1", "lab_B")
    got = {(r.probe_nr, r.par_name): (r.numeric_value, r.out_of_limit) for r in long.collect()}
    assert got[("L1", "isotope_2h")] == (0.75, "<")
    assert got[("L2", "isotope_18o")] == (-8.4, "")
    assert got[("L2", "cond_field")] == (None, None)
    assert long.select("probenahme", "labor").distinct().collect()[0].asDict() == {"probenahme": "crew_1", "labor": "lab_B"}


def test_template_and_import_plan(spark):
    names = spark.createDataFrame([("Na",), ("Cl",), ("Na",)], "VariableName_org string")
    from wellspring.operators.joins import unmapped_template

    path = K.write_template(unmapped_template(names), scratch_path(spark, "t-template"))
    back = spark.read.option("header", True).csv(path).collect()
    assert [r.VariableName_org for r in back] == ["Cl", "Na"] and back[0].para_id is None
    paths = spark.createDataFrame(
        [("/d/GWNMITTE_91.ods",), ("/d/B2-west.ods",), ("/d/cl25.ods",), ("/d/other.ods",)], "ods_paths string"
    )
    plan = {r.ods_names_clean: r.skip_rows for r in SR.import_plan(paths).collect()}
    assert plan == {"gwnmitte_91": 2, "b2_west": 1, "other": 0}
    assert F is not None
