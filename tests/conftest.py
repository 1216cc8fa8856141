import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwright.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, shuffle_partitions=4, memory="6g", app="tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def panel(spark):
    """100 entities x 3 years with the columns of the clinical example."""
    rows = []
    for i in range(100):
        for year in (2018, 2019, 2020):
            h = (i * 37 + year * 11) % 100
            rows.append((f"P{i:04d}", year, 25 + (i * 7 + year) % 60, "M" if i % 2 else "F", 18.0 + h / 5, 100.0 + h,
                         60.0 + h / 3, 150.0 + h, 70.0 + h, ("Never", "Former", "Current")[i % 3], h % 7, h % 4,
                         h % 5 == 0, ("I10", "E11", "I25", "J44")[(i + year) % 4], 1 if h % 9 == 0 else 0))
    return spark.createDataFrame(
        rows, "patient_id string, year int, age int, gender string, bmi double, systolic_bp double, diastolic_bp double, "
              "cholesterol double, glucose double, smoking_status string, num_visits int, medications_count int, "
              "lab_abnormal_flag boolean, primary_diagnosis string, target int")
