"""The load from archives to reports, step by step."""

import json
import zipfile

from overlake import MatchTables
from overlake.__main__ import main
from overlake.sources import BronzeStore, read_silver
from tests import documents as docs


def _archive(path, found):
    with zipfile.ZipFile(path, "w") as z:
        for key, doc in found.items():
            z.writestr(key.split("/")[-1] + ".json", json.dumps(doc))


def test_archives_to_reports(spark, tmp_path, capsys):
    first, second = tmp_path / "first", tmp_path / "second"
    for folder in (first, second):
        folder.mkdir()
    _archive(first / "all.zip", docs.ALL)
    _archive(second / "recent.zip", {"t20/2012/1001": docs.FIRST_CORRECTED, "t20/2012/1002": docs.CHASE})
    bronze, silver, store = (str(tmp_path / n) for n in ("bronze", "silver", "store"))

    main(["bronze", "--bronze", bronze, "--archives", str(first), "--batch", "0"])
    main(["silver", "--bronze", bronze, "--silver", silver])
    main(["bronze", "--bronze", bronze, "--archives", str(second), "--batch", "1"])
    main(["silver", "--bronze", bronze, "--silver", silver, "--mode", "incremental", "--since-batch", "1"])
    shown = capsys.readouterr().out
    assert f"processed {len(docs.ALL)}, errors 0" in shown and "processed 1, errors 0" in shown
    assert "updated" in shown and "skipped" in shown
    assert BronzeStore(spark, bronze).current().count() == len(docs.ALL)
    assert read_silver(spark, silver, "matches").count() == len(docs.ALL) + 1

    main(["build", "--silver", silver, "--store", store])
    tables = MatchTables.load(spark, store)
    opener = tables.took_part.filter("match_id = '1001' AND player_name = 'A Opener' AND innings_number = 1").first()
    assert opener.runs == 7
    main(["build", "--silver", silver, "--store", store, "--mode", "incremental"])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*") if p.is_file()}
    main(["check", "--store", store])
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*") if p.is_file()}
    assert tables.stg_matches.count() == len(docs.ALL) and tables.seeds.team_map.count() > 0
    main(["check", "--silver", silver])
    main(["reconcile", "--store", store])
    assert "accepted_values" in capsys.readouterr().out


def test_files_to_silver_and_inventory(spark, raw, tmp_path, capsys):
    main(["silver", "--raw", raw, "--silver", str(tmp_path / "silver"), "--mode", "full"])
    main(["inventory", "--raw", raw])
    shown = capsys.readouterr().out
    assert f"processed {len(docs.ALL)}, errors 1" in shown and "unknown" in shown
    ledger = ["silver", "--raw", raw, "--silver", str(tmp_path / "other"), "--ledger", str(tmp_path / "ledger")]
    main(ledger)
    main(ledger)
    assert [line for line in capsys.readouterr().out.splitlines() if line.startswith("files")] == [f"files {len(docs.ALL) + 1}", "files 0"]


def test_a_failed_build_keeps_the_tables(spark, ingested, tmp_path):
    import pytest

    from overlake import Seeds, Silver

    store = str(tmp_path / "store")
    silver = Silver.read(spark, ingested[0])
    good = MatchTables(silver, Seeds.standard(spark), store).build()
    n = good.balls.count()
    broken = Silver(silver.matches, silver.innings, silver.deliveries, silver.players.selectExpr("*", "raise_error('x') AS e").drop("team"))
    with pytest.raises(Exception):
        MatchTables(broken, Seeds.standard(spark), store).build()
    assert MatchTables.load(spark, store).balls.count() == n
    again = MatchTables(silver, Seeds.standard(spark), store).build()
    assert MatchTables.load(spark, store).balls.count() == n and again._version != good._version


def test_reports_are_whole(spark, tmp_path, capsys):
    from overlake.__main__ import _print

    _print(spark.range(1500).selectExpr("id"))
    assert len(capsys.readouterr().out.splitlines()) == 1501
