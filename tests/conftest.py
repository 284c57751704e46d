import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bedflow.schemas import ENCOUNTERS  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bedflow.session import local_session
    s = local_session("*", shuffle_partitions=8, app="bedflow-tests")
    yield s
    s.stop()


def enc_row(serial, admit_date, patient_type, los, service="SURG", care_class="Inpatient",
            admit_type="Urgent", location="Ward A", site="Main", holiday="N",
            service_name=None, hour=0):
    d = admit_date if isinstance(admit_date, dt.date) else dt.date.fromisoformat(admit_date)
    return (str(serial), d, dt.datetime(d.year, d.month, d.day, hour), patient_type, los, service,
            service_name or service, admit_type, care_class, location, site, holiday)


@pytest.fixture
def make_encounters(spark):
    def build(rows):
        return spark.createDataFrame(rows, ENCOUNTERS)
    return build
