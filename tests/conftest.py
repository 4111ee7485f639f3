import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def as_of():
    return date(2026, 6, 2)


@pytest.fixture
def now():
    return datetime(2026, 6, 2, 8, 30)


@pytest.fixture
def series(spark):
    """Long values of one feature ``x`` from {iso day: value}."""

    def build(values, feature="x"):
        rows = [(date.fromisoformat(d), feature, float(v)) for d, v in values.items()]
        return spark.createDataFrame(rows, "day date, feature string, value double")

    return build


@pytest.fixture
def sample(spark):
    """Small inputs in the shape of the two facts and the lookup."""
    visits = spark.createDataFrame(
        [
            ("2026-01-01", "00348", "C", "PROGRAMADA", "MEDFAM", "C9C", "PRIMERA"),
            ("2026-01-01", "443", "C", "PROGRAMADA", "INF", "c9c ", "SEGUIMENT"),
            ("2026-01-02 10:15:00", "65", "D", "URGENT", "PED", "D9D", "DOMICILI"),
            ("2026-01-02", "4903", "C", None, "INF", None, "SEGUIMENT"),
            ("2026-01-04", "130", "H", "URGENT", "U__RG", "CALTRE", "URGENT"),
            ("2026-01-04", None, "C", "  ", "INF", "9T", "TELEFON"),
            ("not a day", "348", "C", "URGENT", "URG", "C9C", "URGENT"),
            ("2027-01-01", "348", "C", "URGENT", "URG", "C9C", "URGENT"),
        ],
        "DATA_VISITA string, UP string, VISI_LLOC_VISITA string, VISI_SITUACIO_VISITA string, "
        "SERVEI_CODI string, TIPUS_CLASS string, VISI_TIPUS_VISITA string",
    )
    coded = spark.createDataFrame(
        [
            ("2026-01-01", "00348", "J00"),
            ("2026-01-01", "00443", "j06.9"),
            ("2026-01-01", "65", "J10"),
            ("2026-01-02", "4903", "J21"),
            ("2026-01-02", "130", "A09"),
            ("2026-01-03", "5", " F41"),
            ("2026-01-03", "8368", "U07.1"),
            ("2026-01-04", "999999", "Z99"),
            ("2026-01-04", None, "I10"),
            ("2026-01-05", "348", ""),
            ("2026-01-05", "348", None),
        ],
        "data_visita string, up_c string, problema_salut_c string",
    )
    lookup = spark.createDataFrame(
        [
            ("348", "Girona"),
            ("00443", " BARCELONA CIUTAT "),
            ("00065", "CAMP DE TARRAGONA"),
            ("04903", "CAMP DE TARRAGONA"),
            ("00130", "GIRONA"),
            ("00005", "ALT PIRINEU i ARAN"),
            ("08368", "TERRES DE L'EBRE"),
        ],
        "`Codi UP` string, RS string",
    )
    return visits, coded, lookup
