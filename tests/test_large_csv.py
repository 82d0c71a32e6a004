import random

import pytest

from labelloom.sources.large_csv import csv_records, read_large_questions_csv
from labelloom.sources.questions import read_questions_csv


def _field(rng):
    return "".join(rng.choice(["word ", '""', "\n", ",", "é", "\n\n", "x" * rng.randrange(40)]) for _ in range(rng.randrange(9)))


def _file(rng, n, ending="\n"):
    rows = [f'{i},"{_field(rng)}","{_field(rng)}",{rng.choice(["a b", "", chr(34) + "c" + chr(34)])}' for i in range(n)]
    return ending.join(["id,title,body,tags", *rows, ""])


def _rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("range_bytes, sent", [(64, 10_000), (301, 10_000), (301, 0), (1 << 20, 10_000)])
def test_ranges_equal_the_whole_scan(spark, tmp_path, range_bytes, sent):
    rng = random.Random(range_bytes)
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text(_file(rng, 60), newline="")
    (tmp_path / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ours = _rows(read_large_questions_csv(spark, str(tmp_path), range_bytes, sent))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert ours == _rows(read_questions_csv(spark, str(tmp_path)))
    assert len(ours) == 120


def test_long_records_and_odd_ends(spark, tmp_path):
    long = "first\nsecond " * 200
    text = f'id,title,body,tags\r\n\r\n1,t,"{long}",a b\r\n2,"say ""so""",plain,\r\n\r\n3,x,"open to the end\n'
    path = tmp_path / "q.csv"
    path.write_text(text, newline="")
    for range_bytes in (50, 100_000):
        records = {r.record[0]: r.record for r in csv_records(spark, str(path), range_bytes).collect()}
        assert sorted(records) == ["1", "2", "3"]
        assert records["1"] == f'1,t,"{long}",a b' and records["3"] == '3,x,"open to the end'
        rows = {r.id: r for r in read_large_questions_csv(spark, str(path), range_bytes).where("id < 3").collect()}
        assert rows[1].body == long and rows[1].tags == "a b"
        assert (rows[2].title, rows[2].body, rows[2].tags) == ('say "so"', "plain", "")
