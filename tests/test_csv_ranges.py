import random

import pytest

from ladle.sources import csv_ranges as CR
from ladle.sources.files import read_csv

SCHEMA = "Id int, Text string, Tags string, Stars double"


def cell(rng):
    atoms = ["plain", 'a "quoted" word', "x,y", "line\nbreak", "two\n\nbreaks", "\r\n", "é 한", "", " padded ", "\n", '"', "'", "many\n" * 20]
    return "".join(rng.choice(atoms) for _ in range(rng.randint(0, 3)))


def quoted(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\r\n') else text


def write(path, rng, n, end="\n", last=True):
    rows = [f'{i},{quoted(cell(rng))},"c(""a"", NA)",{rng.choice(["1.5", "", "2"])}' for i in range(n)]
    path.write_bytes((end.join(["Id,Text,Tags,Stars", *rows]) + (end if last else "")).encode())


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(v)) for n, v in zip(names, (size, 1))]
    for n, v in old.items():
        spark.conf.set(n, v)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("size", [150, 900, 10_000_000])
def test_equal_to_the_multi_line_read(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    write(tmp_path / "a.csv", rng, 60)
    write(tmp_path / "b.csv", rng, 30, end="\r\n")
    write(tmp_path / "c.csv", rng, 20, last=False)
    (tmp_path / "d.csv").write_bytes(b"Id,Text,Tags,Stars\n")
    (tmp_path / "e.csv").write_bytes(b"")
    (tmp_path / "f.csv").write_bytes(('Id,Text,Tags,Stars\n1,"' + "long\n" * 200 + '",,\n\n\n2,b,,\n').encode())  # over many ranges
    want = rows(read_csv(spark, str(tmp_path), SCHEMA, ["Tags"], multi_line=True))
    small_ranges(size)
    assert len(want) == 112
    assert rows(CR.read_csv_ranges(spark, str(tmp_path), SCHEMA, ["Tags"])) == want
    tasks = CR._lines(spark, f"{tmp_path}/a.csv").rdd.getNumPartitions()
    assert tasks > 8 if size == 150 else True


def test_ranges_know_how_they_begin(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_bytes(b'h\n"' + b"in\n" * 100 + b'"\n' + b"out\n" * 100)
    small_ranges(50)
    found = sorted((r.range_start, r.inside) for r in CR.range_parities(CR._lines(spark, str(tmp_path))).collect())
    assert found[0][1] is False and found[1][1] is True and found[-1][1] is False and len(found) > 10


def test_unclosed_quotes_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'Id,Text\n1,"open\n2,b\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        CR.read_csv_ranges(spark, str(tmp_path), "Id int, Text string")
