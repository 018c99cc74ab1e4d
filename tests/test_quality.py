import pytest

from roadlake import rules
from roadlake.operators import quality
from tests.conftest import values

SCHEMA = "report_id string, event_id string, event_time int, latitude double, longitude double, severity_score int, confidence double"


@pytest.fixture
def reports(frame):
    return frame(
        SCHEMA,
        ("a", "e1", 1, -7.2, 112.7, 50, 0.5), ("a", "e2", 2, -7.2, 112.7, 500, 0.5), ("b", "e3", 1, -7.2, 112.7, 10, 0.1),
        (None, "e4", 1, 0.0, 0.0, 10, 0.1), ("c", "e5", 1, None, None, None, None), ("d", "e6", 1, 0.0, 112.7, -1, 0.1),
    )


def test_range_rules(reports):
    rows = quality.check_ranges(reports, rules.RANGE_RULES["reports"]).orderBy("event_id")
    assert values(rows, "severity_score_ok", "violations") == [
        (True, []), (False, ["severity_score"]), (True, []), (True, ["latitude", "longitude"]), (True, []),
        (False, ["latitude", "severity_score"]),
    ]


def test_metrics(reports):
    row = values(quality.metrics(reports, "silver", "reports", ["report_id"], rules.RANGE_RULES["reports"]))
    # good: b and c; the older "a" is a copy, the newer one and "d" are out of range
    assert row == [("silver", "reports", 6, 1, 1, pytest.approx(2 / 6))]
    assert values(quality.metrics(reports, "silver", "reports", ["report_id"]))[0][-1] == pytest.approx(4 / 6)
    assert values(quality.metrics(reports.limit(0), "silver", "r", ["report_id"])) == [("silver", "r", 0, 0, 0, 1.0)]


def test_run_log(reports, tmp_path):
    logs = []
    quality.run_logged(reports, "job", "silver", lambda df: df.write.parquet(str(tmp_path / "t")), logs.append)
    assert values(logs[0], "job_name", "status", "record_processed", "error_message") == [("job", "success", 6, None)]

    def fail(_):
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        quality.run_logged(reports, "job", "silver", fail, logs.append)
    assert values(logs[1], "status", "record_processed", "error_message") == [("failed", None, "disk full")]
    started, ended = values(logs[0], "start_time", "end_time")[0]
    assert started <= ended
