"""The zone map: what is pruned is never missed, and what is new or changed is read again."""

import json

from merchant_ledger.operators import parsing
from merchant_ledger.sources.zones import ZoneMap


def write(folder, name, times):
    folder.mkdir(exist_ok=True)
    lines = []
    for i, ms in enumerate(times):
        image = {"pay_order_id": "O", "mch_no": "M", "amount": 1, "state": 2}
        lines.append(json.dumps({"op": "u", "after": image, "source": {"pos": i, "file": name}, "ts_ms": ms}))
    (folder / name).write_text("\n".join(lines) + "\n")


def started(lines, millis):
    records = parsing.start_from(parsing.classified(lines), millis)
    return sorted((str(r["ts_ms"]), str(r["pos"])) for r in records.collect())


def names(lines):
    return sorted(path.rpartition("/")[2] for path in lines.inputFiles())


def test_only_files_that_matter_are_read(spark, tmp_path):
    log = tmp_path / "log"
    for number in range(6):
        write(log, f"log.{number}", range(number * 100, number * 100 + 100))
    write(log, "untimed", [5, None, 7])
    (log / "broken").write_text("no json at all\n")
    zones = ZoneMap(spark, str(log), str(tmp_path / "zones"))
    assert zones.update() == 8 and zones.update() == 0
    late = zones.lines_from(450)
    assert names(late) == ["broken", "log.4", "log.5", "untimed"]
    assert started(late, 450) == started(spark.read.text(str(log)), 450)
    assert names(zones.lines_from(10**9)) == ["broken", "untimed"]
    assert names(zones.lines_from_position(99)) == ["broken"] + [f"log.{i}" for i in range(6)]


def test_new_and_grown_files(spark, tmp_path):
    log = tmp_path / "log"
    write(log, "a", [1, 2])
    write(log, "b", [3, 4])
    zones = ZoneMap(spark, str(log), str(tmp_path / "zones"))
    zones.update()
    write(log, "a", [1, 2, 50])
    write(log, "c", [9])
    # Without a zone a file is read, whatever is asked for.
    assert names(zones.lines_from(60)) == ["a", "c"]
    assert zones.update() == 2
    assert names(zones.lines_from(60)) == []
    assert zones.lines_from(60).count() == 0
    assert names(zones.lines_from(10)) == ["a"]


def test_zones_written_twice_count_once(spark, tmp_path):
    log = tmp_path / "log"
    write(log, "a", [1, 2])
    zones = ZoneMap(spark, str(log), str(tmp_path / "zones"))
    zones.update()
    zones.zones().coalesce(1).write.mode("append").parquet(str(tmp_path / "zones"))
    assert zones.lines_from(0).count() == 2
