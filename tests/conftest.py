import datetime as dt
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitlake import schema  # noqa: E402
from pitlake.session import tune  # noqa: E402

KEY = "test-key-" + "k" * 40


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("pitlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def raw_rows(n=600, judges=12, seed=7):
    """Court-like rows with a signal: the judge moves both the amount and the outcome."""
    rng = random.Random(seed)
    places = [("MS", "Campo Grande"), ("SP", "Santos"), ("RJ", "Niterói"), ("PR", "Londrina")]
    varas = ["Cível", "Fazenda", "Juizado"]
    outcomes = [*schema.UNFAVORABLE_OUTCOMES, *schema.FAVORABLE_OUTCOMES]
    rows = []
    for i in range(n):
        j = rng.randrange(judges)
        uf, comarca = places[j % 4]
        filed = dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(900))
        number = f"{i:07d}-{i % 97:02d}.{filed.year}.8.12.{j:04d}"
        party, judge = f"Pessoa {chr(65 + i % 26)}{chr(97 + i % 23)}", f"Juiz Nome{chr(65 + j)}"
        bad = rng.random() < 0.15 + 0.7 * (j % 2)
        cpf = f"{i % 1000:03d}.{j:03d}.{i % 777:03d}-{i % 97:02d}"
        rows.append(
            (
                number, cpf, party, judge, uf, comarca, varas[j % 3], filed,
                filed + dt.timedelta(days=30 + rng.randrange(200)),
                None if rng.random() < 0.03 else round(1000 * 1.6 ** (j % 6) * (0.6 + rng.random()), 2),
                outcomes[rng.randrange(2) if bad else 2 + rng.randrange(2)],
                f"No processo {number}, {party} (CPF {cpf}) em {comarca}, por {judge}.",
                None if i % 5 else i % 50 == 0,
            )
        )
    return rows + rows[: n // 100]


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(raw_rows(), schema.RAW_SCHEMA)


@pytest.fixture(scope="session")
def key():
    return KEY


@pytest.fixture(scope="session")
def cases(spark, raw):
    from pitlake.operators import privacy, tables
    from pitlake.session import stage

    return stage(tables.to_cases(privacy.anonymise(raw, KEY)), "test-cases")


def book_rows(n=40):
    """Appeals of a made-up court: the outcome follows a hash of the number, every ninth has none on the merits."""
    on_merits = ["Reformou", "Não reformou", "Parcial", "Não reformou"]
    labels = {"Reformou": 1, "Parcial": 1, "Não reformou": 0}
    rows = []
    for number in range(1, n + 1):
        draw = random.Random(number)
        outcome = "Desistência" if number % 9 == 0 else draw.choice(on_merits)
        filed = dt.date(2018, 3, 5) + dt.timedelta(days=draw.randrange(1500))
        days = draw.randrange(20, 400)
        rows.append(
            (
                f"BOOK_{number * 7919:016X}", draw.choice(["Seguro", "Transporte Aéreo", "Água e Esgoto"]),
                draw.choice(["BAURU", "OSASCO", "FRANCA", "JUNDIAI"]), draw.choice(["PF-nPF", "PF-PF"]), filed,
                filed + dt.timedelta(days=days), round(draw.uniform(300, 90_000), 2), outcome, labels.get(outcome), "Maioria", days,
            )
        )
    return rows


@pytest.fixture(scope="session")
def book(spark):
    return spark.createDataFrame(book_rows(), schema.BOOK_SCHEMA)
