import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine import schemas  # noqa: E402
from vitrine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


def page_row(store_id, seq, url, body, **extra):
    """One crawled page in the order of schemas.PAGES."""
    row = {
        "store_id": store_id, "page_seq": seq, "requested_url": url, "final_url": url, "status_code": 200,
        "fetched_at": None, "content_type": "text/html", "body": body, "headers": {}, "redirect_history": [],
        "robots_allowed": True, "error": None,
    }
    row.update(extra)
    return tuple(row.values())


@pytest.fixture(scope="session")
def make_pages(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.PAGES)


@pytest.fixture(scope="session")
def no_hosts(spark):
    return spark.createDataFrame([], schemas.CART_FACTS), spark.createDataFrame([], schemas.DNS_FACTS)
