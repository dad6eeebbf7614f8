import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ingotflow.schemas import EVENT, EVENT_COLUMNS  # noqa: E402
from ingotflow.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session("tests", **{
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "order_id": "A", "customer_id": "c1", "customer_name": "Ann", "customer_email": "a@example.com",
    "order_status": "PENDING", "product_id": "p1", "product_name": "Lamp",
    "product_category": "Home", "quantity": 1, "unit_price": 5.0, "total_amount": 5.0,
    "currency": "USD", "order_timestamp": datetime(2024, 1, 1, 10), "shipping_address_city": "Oslo",
    "shipping_address_state": "Oslo", "shipping_address_country": "Norway",
}


@pytest.fixture
def events(spark):
    """Event rows from the columns that matter to a test."""
    def make(*rows: dict):
        return spark.createDataFrame(
            [tuple({**DEFAULTS, **row}[c] for c in EVENT_COLUMNS) for row in rows], EVENT)
    return make


@pytest.fixture
def base(tmp_path):
    return f"file://{tmp_path}"
