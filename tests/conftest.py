import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from coinloft.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "coinloft-tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AS_OF = dt.date(2025, 2, 1)
RUN_TS = dt.datetime(2025, 2, 1, 6, 0)


@pytest.fixture(scope="session")
def bad_clients(spark):
    """Client rows with one defect each."""
    from pyspark.sql import functions as F

    from coinloft.schemas import source_schema

    d, D = dt.date, __import__("decimal").Decimal
    ok = dict(
        first_name="Ann", last_name="Lee", email="ann@example.com", phone="555-0100", birth_date=d(1985, 1, 1),
        registration_date=d(2020, 1, 1), address="1 Main St", city="Boston", country="US", risk_category="LOW",
        credit_score=700, employment_status="EMPLOYED", annual_income=D("70000.00"),
    )
    changes = {
        1: dict(first_name=None), 2: dict(last_name=None), 3: dict(email=None), 4: dict(phone=None),
        5: dict(birth_date=None), 6: dict(email="invalid-email"), 7: dict(email="emma@@example.com"),
        8: dict(email="frank@"), 9: dict(phone="NOT-A-PHONE"), 10: dict(phone="12345"),
        11: dict(birth_date=d(2030, 1, 1)), 12: dict(risk_category="INVALID"), 13: dict(credit_score=-50),
        14: dict(credit_score=1200), 15: dict(annual_income=D("-10000.00")), 18: dict(birth_date=d(1919, 1, 1)),
        20: dict(credit_score=300, annual_income=D("1.00")),
    }
    rows = [{"client_id": i, **ok, **c} for i, c in changes.items()]
    rows += [{"client_id": 16, **ok}, {"client_id": 16, **ok}]
    rows += [{"client_id": 17, **ok}, {"client_id": 17, **ok, "email": "other@example.com", "registration_date": d(2021, 7, 5)}]
    rows.append({"client_id": 19, **dict.fromkeys(ok), "registration_date": d(2021, 9, 1)})
    schema = source_schema("clients")
    df = spark.createDataFrame([[r[f] for f in schema.names] for r in rows], schema)
    return df.withColumn("load_timestamp", F.lit(RUN_TS))


@pytest.fixture(scope="session")
def bad_transactions(spark):
    from pyspark.sql import functions as F

    from coinloft.schemas import source_schema

    t, D = dt.datetime, __import__("decimal").Decimal
    raw = [
        (1, "U1", 1, 2, "DEPOSIT", "-500", "USD", t(2025, 1, 15, 10, 30), "COMPLETED", "SALARY"),
        (2, "U2", None, 3, "TRANSFER", "1000", "USD", t(2025, 1, 16, 14, 20), "COMPLETED", "OTHER"),
        (3, "U3", 4, 5, "PAYMENT", "250", "USD", t(2030, 12, 31, 23, 59, 59), "COMPLETED", "SHOPPING"),
        (4, "U4", 999999, 888888, "TRANSFER", "5000", "USD", t(2025, 1, 17, 9, 15), "COMPLETED", "OTHER"),
        (5, "U5", 6, 7, "WITHDRAWAL", "300", "USD", t(2025, 1, 18, 16, 45), "UNKNOWN_STATUS", "CASH"),
        (6, "DUP", 8, 9, "TRANSFER", "1500", "USD", t(2025, 1, 19, 11, 0), "COMPLETED", "TRANSFER"),
        (7, "DUP", 10, 11, "PAYMENT", "800", "USD", t(2025, 1, 19, 11, 5), "COMPLETED", "SHOPPING"),
        (8, "U8", 12, 13, "TRANSFER", "99999999.99", "USD", t(2025, 1, 20, 3, 0), "COMPLETED", "OTHER"),
        (9, "U9", 14, 15, "PAYMENT", "0", "USD", t(2025, 1, 21, 12, 30), "COMPLETED", "OTHER"),
        (10, "U10", 16, 17, "TRANSFER", "500", "XXX", t(2025, 1, 22, 15, 20), "COMPLETED", "OTHER"),
    ]
    rows = [
        (i, u, a, b, None, None, k, D(x), c, when, None, s, g, None) for i, u, a, b, k, x, c, when, s, g in raw
    ]
    return spark.createDataFrame(rows, source_schema("transactions")).withColumn("load_timestamp", F.lit(RUN_TS))


@pytest.fixture(scope="session")
def bad_accounts(spark):
    from pyspark.sql import functions as F

    from coinloft.schemas import source_schema

    d = dt.date
    rows = [
        (1, 1, 1, "ACC1", "SAVINGS", "USD", d(2024, 5, 1), d(2023, 5, 1), "CLOSED", "BR001"),
        (2, None, 2, "ACC2", "CHECKING", "USD", d(2024, 1, 1), None, "ACTIVE", "BR001"),
        (3, 999999, 3, "ACC3", "CHECKING", "USD", d(2024, 1, 1), None, "ACTIVE", "BR002"),
        (4, 2, 4, "DUP", "CREDIT", "USD", d(2024, 1, 1), None, "ACTIVE", "BR002"),
        (5, 3, 5, "DUP", "CREDIT", "USD", d(2024, 1, 1), None, "ACTIVE", "BR002"),
        (6, 4, 6, "ACC6", "SAVINGS", "USD", d(2024, 1, 1), None, "INVALID_STATUS", "BR003"),
        (7, 5, 7, "ACC7", "", "USD", d(2024, 1, 1), None, "ACTIVE", "BR003"),
        (8, 6, 8, "ACC8", "LOAN", "USD", d(2030, 1, 1), None, "ACTIVE", "BR003"),
    ]
    return spark.createDataFrame(rows, source_schema("accounts")).withColumn("load_timestamp", F.lit(RUN_TS))
