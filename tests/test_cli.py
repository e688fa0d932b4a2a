"""The command line, stage by stage, and its log lines."""

import json
import logging

import pytest
import yaml
from test_build import COLUMNS, GOLD, ROUTES, SILVER, _raw

from cairn.__main__ import main
from cairn.logs import configure_logging


@pytest.fixture(autouse=True)
def _logger():
    yield
    logging.getLogger("cairn").handlers.clear()


def test_stages(spark, tmp_path, capsys):
    spark.createDataFrame([("SYR", 1), ("AFG", 2)], "iso string, id int").write.parquet(str(tmp_path / "dim"))
    for name, x in {"columns": {"columns": [dict(zip(("raw", "name", "type"), c)) for c in COLUMNS]}, "routes": ROUTES, "silver": SILVER, "gold": GOLD}.items():
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump(x))
    raw, bronze, root, dim = _raw(tmp_path / "a.csv", [(2020, "TUR", "SYR", 10), (2021, "TUR", "AFG", 1)]), str(tmp_path / "bronze" / "src"), str(tmp_path / "lake"), str(tmp_path / "dim")

    def call(*args):
        assert main(list(args)) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert call("snapshot", "--raw", raw, "--out", bronze, "--columns", str(tmp_path / "columns.yaml"), "--start", "2020", "--cutoff", "2021", "--version", "1")["records"] == 2
    assert call("discover", "--root", root, "--bronze", bronze, "--routes", str(tmp_path / "routes.yaml")) == {"dirty": 2}
    silver = ("silver", "--root", root, "--spec", str(tmp_path / "silver.yaml"), "--dim", f"countries={dim}")
    assert [b["rows"] for b in call(*silver)] == [1, 1]
    gold = ("gold", "--root", root, "--spec", str(tmp_path / "gold.yaml"), "--ref", f"dims.country={dim}")
    assert [(b["partition_key"], b["rows"]) for b in call(*gold)] == [("2020", 1), ("2021", 1)]
    assert call("replay", "--root", root, "flows", "flows_yearly") == {"replayed": ["flows", "flows_yearly"]}
    assert [b["rows"] for b in call(*silver)] == [1, 1]

    assert main([*gold, "--key", "2030"]) == 1
    last = json.loads(capsys.readouterr().err.strip().splitlines()[-1])
    assert (last["event"], last["stage"], last["level"]) == ("stage_failed", "gold", "error") and "not promoted" in last["exception"]


def test_arguments(capsys):
    for bad in ([], ["silver", "--root", "r", "--spec", "s", "--dim", "nopath"]):
        with pytest.raises(SystemExit):
            main(bad)
    capsys.readouterr()


def test_log_lines(capsys):
    for _ in range(2):
        log = configure_logging()
    log.info("n %d", 1, extra={"entity": "é"})
    lines = capsys.readouterr().err.strip().splitlines()
    assert len(lines) == 1 and {"event": "n 1", "level": "info", "logger": "cairn", "entity": "é"}.items() <= json.loads(lines[0]).items()
    configure_logging(False).info("plain")
    assert capsys.readouterr().err.rstrip().endswith("INFO cairn: plain")
