"""Records with line breaks, read from many splits, against the CSV reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.schema import RAW_CLAIMS
from claimloom.sources import csv_records, files

HEADER = ",".join(RAW_CLAIMS.names)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def split_bytes(spark):
    """Splits of a given size, and the setting as it was afterwards."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def both(spark, path, split_bytes, size):
    """(claims, corrupt) from one task for each file, and from splits of `size` bytes."""
    split_bytes("1g")
    whole = rows(files.read_csv(spark, path)), rows(files.corrupt_records(spark, path))
    split_bytes(str(size))
    parted = files.csv_claims(spark, path)
    return whole, (rows(parted.claims), rows(parted.corrupt))


def field(pick):
    """A field as programs write it: plain, quoted, with doubled quotes, delimiters, line breaks, or a quote inside."""
    return pick.choice(["", "x", "PAID", '""', '"a,b"', '"say ""no"""', '"two\nlines"', '"""\n"""', '"a\n\n,b\n"', '6" pipe', "a b", '"\n"', "é", '" x"'])


@pytest.mark.parametrize("seed", range(3))
def test_same_records_whatever_the_splits(spark, tmp_path, split_bytes, seed):
    pick = random.Random(seed)
    for number in range(3):
        records = []
        for _ in range(pick.choice([0, 1, 40, 90])):
            count = pick.choice([13] * 12 + [1, 12, 14])
            records.append(",".join(field(pick) for _ in range(count)))
        records = [r for r in records if r]
        (tmp_path / f"part-{number}.csv").write_text("\n".join([HEADER, *records]) + pick.choice(["", "\n"]))
    whole, parted = both(spark, str(tmp_path), split_bytes, (400, 1000, 3000)[seed])
    assert parted == whole


def test_line_breaks_of_two_kinds_and_empty_lines(spark, tmp_path, split_bytes):
    good = ",".join(["x"] * 13)
    (tmp_path / "one.csv").write_bytes(f"{HEADER}\r\n{good}\r\n\r\n{good}\r\n".encode())
    (tmp_path / "two.csv").write_bytes(f"\n{HEADER}\n\n{good}\n\n\n".encode())
    whole, parted = both(spark, str(tmp_path), split_bytes, 90)
    assert parted == whole and len(whole[0]) == 3


def test_a_record_longer_than_several_splits(spark, tmp_path, split_bytes):
    long = '"' + "line, one\n" * 200 + '"'
    text = ",".join(["a", long, *["x"] * 11])
    (tmp_path / "one.csv").write_text("\n".join([HEADER, ",".join(["k"] * 13), text, ",".join(["z"] * 13), text]) + "\n")
    whole, parted = both(spark, str(tmp_path), split_bytes, 400)
    assert parted == whole and len(whole[0]) == 4


def test_a_quote_that_is_never_closed(spark, tmp_path, split_bytes):
    lines = [",".join([f"{i}", *["x"] * 12]) for i in range(30)]
    (tmp_path / "one.csv").write_text("\n".join([HEADER, *lines[:20], '"open,' + lines[20], *lines[21:]]))
    split_bytes("100")
    parted = files.csv_claims(spark, str(tmp_path))
    assert parted.claims.count() == 20 and parted.corrupt.count() == 1


def test_one_file_is_many_tasks_and_parsed_once(spark, claims, tmp_path, split_bytes):
    many = claims({}).crossJoin(spark.range(3000)).withColumn("claim_id", F.expr("IF(id % 1600 = 100, concat('a\n\"', id), string(id))")).drop("id")
    files.write_csv(many.coalesce(1), str(tmp_path / "raw"))
    split_bytes("40k")
    lines = csv_records.read_lines(spark, str(tmp_path / "raw"))
    assert lines.rdd.getNumPartitions() > 5
    splits = csv_records.split_states(lines)
    assert splits.where("plain").count() > splits.where("NOT plain").count() > 0
    parted = files.csv_claims(spark, str(tmp_path / "raw"))
    assert rows(parted.claims) == rows(many.select(*RAW_CLAIMS.names)) and parted.corrupt.count() == 0
    # Both frames read the stored parse, not the CSV.
    assert all(file.endswith(".parquet") for frame in parted for file in frame.inputFiles())


STATES = [
    ("a,b", False, True), ('"a",b', False, False), ('a,"b', True, False), ('b",c', False, False), ('b","c', True, True), ('"a""b', True, False),
    ('a"b,c', False, False), ('a"b,"c', True, True), ('""', False, True), ('"",""', False, True), ('"""', True, False), ('x"","y', True, False), ("", False, True),
]


def test_states_of_a_line(spark, tmp_path):
    (tmp_path / "f.csv").write_text("".join(line + "\n" for line, _, _ in STATES))
    found = csv_records.read_lines(spark, str(tmp_path)).orderBy("at").collect()
    assert [(r.line, r.from_closed, r.from_open) for r in found] == STATES
