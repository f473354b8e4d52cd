import json

from martloom.sources import read_stored
from martloom.streaming.arrivals import stream_new_rows
from tests.conftest import rows


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"result": [r]}) for r in records) + "\n")


def test_only_unseen_ids_are_appended(spark, tmp_path):
    landed = tmp_path / "landed"
    args = (spark, str(landed), str(tmp_path / "stored"), str(tmp_path / "checkpoint"), ["ID", "V"])
    land(landed, "a.json", {"ID": "1", "V": "x"}, {"ID": "1", "V": "x"}, {"ID": "2", "V": "non sélectionné"})
    stream_new_rows(*args)
    assert rows(read_stored(spark, str(tmp_path / "stored"))) == [("1", "x"), ("2", None)]
    land(landed, "b.json", {"ID": "2", "V": "late"}, {"ID": "3", "V": "z"})
    stream_new_rows(*args, files_per_batch=1)
    assert rows(read_stored(spark, str(tmp_path / "stored"))) == [("1", "x"), ("2", None), ("3", "z")]


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed, "a.json", {"ID": "1", "V": "x"})
    for checkpoint in ("one", "two"):  # the second one has forgotten that the file is done
        stream_new_rows(spark, str(landed), str(tmp_path / "stored"), str(tmp_path / checkpoint), ["ID", "V"])
    assert rows(read_stored(spark, str(tmp_path / "stored"))) == [("1", "x")]
