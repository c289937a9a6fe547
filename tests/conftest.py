import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sitewarden.session import local_session

    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def cities(spark):
    """Five sites with the attributes of the sites table."""
    rows = [
        (1, 394, "Venice", "Cultural", 1987, "Italy", "IT", False, 5000.0, 12.3155, 45.4408),
        (2, 91, "Rome", "Cultural", 1980, "Italy", "IT, VA", False, 1400.0, 12.4964, 41.9028),
        (3, 404, "Athens", "Cultural", 1987, "Greece", "GR", False, 3.0, 23.7275, 37.9838),
        (4, 356, "Istanbul", "Cultural", 1985, "Turkey", "TR", True, 700.0, 28.9784, 41.0082),
        (5, 488, "London", "Cultural", 1988, "United Kingdom", "GB", False, 2.0, -0.1276, 51.5074),
    ]
    return spark.createDataFrame(
        rows,
        "site_id bigint, whc_id int, name string, category string, date_inscribed int, country string, "
        "iso_code string, in_danger boolean, area_hectares double, lon double, lat double",
    )
