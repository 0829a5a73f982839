"""Files, load-or-build, the shared folder and connection options."""

from types import SimpleNamespace

import pytest

from claimloom.schema import RAW_CLAIMS
from claimloom.sources import files, jdbc


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


DIRTY = (
    {"drug_class": " diabetes ", "drug_name": 'Insulin "U-100", long'},
    {"ndc_code": "00000000001", "claim_amount": None, "claim_status": None},
    {"claim_amount": 0.1 + 0.2, "quantity": 1e7, "days_supply": None},
    {"service_date": "2024/01/05", "member_state": None, "drug_name": "back\\slash"},
)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_roundtrip_keeps_every_value(spark, claims, tmp_path, kind):
    raw = claims(*DIRTY)
    path = str(tmp_path / kind)
    getattr(files, f"write_{kind}")(raw, path)
    back = getattr(files, f"read_{kind}")(spark, path)
    assert rows(back) == rows(raw)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in RAW_CLAIMS]


def test_malformed_csv_numbers_become_null(spark, claims, tmp_path):
    path = tmp_path / "one.csv"
    names = ",".join(RAW_CLAIMS.names)
    path.write_text(f"{names}\nA,M,007,d,c,1,2024-01-01,abc,30,x,P,FL,PAID\nB,M,007,d,c,1,2024-01-01,5.5,30,30,P,FL,PAID\n"
                    "C,M,007,d,c,1,2024-01-01,5,60.0,90.0,P,FL,PAID\n")
    back = {row["claim_id"]: row for row in files.read_csv(spark, str(path)).collect()}
    assert (back["A"]["claim_amount"], back["A"]["days_supply"], back["A"]["ndc_code"]) == (None, None, "007")
    assert (back["B"]["claim_amount"], back["B"]["days_supply"]) == (5.5, 30)
    assert (back["C"]["claim_amount"], back["C"]["quantity"], back["C"]["days_supply"]) == (5.0, 60.0, 90)


BROKEN = {"drug_name": 'two "quoted"\nlines, and\r\nmore', "drug_class": "", "plan_id": None}


def test_line_breaks_quotes_separators_and_empty_texts_come_back(spark, claims, tmp_path):
    raw, path = claims(BROKEN, {}, {"member_state": 'a "b", c'}), str(tmp_path / "csv")
    files.write_csv(raw, path)
    assert rows(files.read_csv(spark, path)) == rows(raw)
    assert files.corrupt_records(spark, path).count() == 0
    with pytest.raises(Exception, match="line break in drug_name"):
        files.write_csv(raw, str(tmp_path / "flat"), multi_line=False)
    flat = raw.where("plan_id IS NOT NULL")
    files.write_csv(flat, str(tmp_path / "split"), multi_line=False)
    assert rows(files.read_csv(spark, str(tmp_path / "split"), multi_line=False)) == rows(flat)


@pytest.mark.parametrize("multi_line", [True, False])
def test_records_with_other_numbers_of_fields_are_corrupt(spark, tmp_path, multi_line):
    path = tmp_path / "some.csv"
    good = "A,M,007,d,c,1,2024-01-01,5,30,30.7,P,FL,PAID"
    path.write_text("\n".join([",".join(RAW_CLAIMS.names), good, good + ",x,y", "A,M,007,d,c", ""]))
    read = files.read_csv(spark, str(path), multi_line)
    assert [(r["claim_id"], r["days_supply"]) for r in read.collect()] == [("A", None)]
    assert read.select("claim_id").count() == 1
    found = {r[0].strip() for r in files.corrupt_records(spark, str(path), multi_line).collect()}
    assert found == {good + ",x,y", "A,M,007,d,c"}


def test_load_or_build(spark, claims, tmp_path):
    path, built = str(tmp_path / "claims"), []

    def build():
        built.append(1)
        return claims({}, {})

    first = rows(files.load_or_build(spark, path, build))
    assert rows(files.load_or_build(spark, path, build)) == first and len(built) == 1


def test_load_or_build_repeats_an_unfinished_write(spark, claims, tmp_path):
    path = tmp_path / "claims"
    (path / "_temporary").mkdir(parents=True)
    assert files.load_or_build(spark, str(path), lambda: claims({})).count() == 1


def test_day_folders(spark, claims, tmp_path):
    raw = claims(*[{"service_date": d} for d in ("2024-01-01", "2024-01-02", "2024-01-02", None, "bad/date")])
    root = str(tmp_path / "days")
    files.write_by_day(raw, root)
    assert rows(files.read_day(spark, root, "2024-01-02")) == rows(raw.where("service_date = '2024-01-02'"))
    assert files.read_day(spark, root, "2024-01-03").count() == 0
    assert rows(files.read_parquet(spark, root).select(*RAW_CLAIMS.names)) == rows(raw)
    assert {x.name for x in (tmp_path / "days").glob("day=*")} == {"day=2024-01-01", "day=2024-01-02", "day=undated-all"}
    assert all("/day=2024-01-02/" in file for file in files.read_day(spark, root, "2024-01-02").inputFiles())


def dated(claims, *days, **change):
    return claims(*[{"service_date": day, **change} for day in days])


def test_a_day_replaces_itself_alone(spark, claims, tmp_path):
    root = str(tmp_path / "days")
    first, second = dated(claims, "2024-01-01", "2024-01-01", None), dated(claims, "2024-01-02", "no date")
    files.write_by_day(first, root, "one")
    before = sorted(map(str, (tmp_path / "days" / "day=2024-01-01").iterdir()))
    files.write_by_day(second, root, "two")
    assert sorted(map(str, (tmp_path / "days" / "day=2024-01-01").iterdir())) == before
    assert rows(files.read_days(spark, root)) == rows(first.union(second))
    files.write_by_day(first, root, "one")
    assert rows(files.read_days(spark, root)) == rows(first.union(second))
    assert files.days_stored(spark, root) == ["2024-01-01", "2024-01-02"]
    corrected = dated(claims, "2024-01-01", quantity=90.0)
    files.write_by_day(corrected, root, "one")
    assert rows(files.read_day(spark, root, "2024-01-01")) == rows(corrected)
    # The undated claim of the first batch went with its replay, that of the second stays.
    assert rows(files.read_days(spark, root)) == rows(corrected.union(second))


def test_a_day_that_lost_its_claims_is_emptied_by_name(spark, claims, tmp_path):
    root = str(tmp_path / "days")
    files.write_by_day(dated(claims, "2024-01-01", "2024-01-02"), root)
    files.write_by_day(dated(claims, "2024-01-02"), root, emptied=("2024-01-01", "2024-01-02", "2024-01-09"))
    assert files.days_stored(spark, root) == ["2024-01-02"]
    assert files.read_day(spark, root, "2024-01-01").count() == 0 and files.read_days(spark, root).count() == 1
    files.write_by_day(dated(claims, "2024-01-02").limit(0), root)
    assert files.days_stored(spark, root) == ["2024-01-02"]
    for wrong in ({"batch": "a/b"}, {"emptied": ("2024-13-01",)}, {"emptied": ("../x",)}):
        with pytest.raises(ValueError):
            files.write_by_day(dated(claims, "2024-01-02"), root, **wrong)
    assert files.read_days(spark, str(tmp_path / "none")).count() == 0


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/folder/name"
    assert files.read_small(spark, path) is None
    for text in ("one", "zwei \u00e9"):
        files.write_small(spark, path, text)
        assert files.read_small(spark, path) == text
    assert files.names_in(spark, f"{tmp_path}/folder") == ["name"]
    one = files.fingerprint(spark, f"{tmp_path}/folder")
    files.write_small(spark, path, "longer than before")
    assert files.fingerprint(spark, f"{tmp_path}/folder") != one == one


def test_shared_dir_is_new_and_below_the_checkpoint_folder(spark):
    one, two = files.shared_dir(spark), files.shared_dir(spark)
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_connection_options():
    config = {
        "database": {"host": "db", "port": 5432, "name": "dwh", "user": "u", "password": "p"},
        "snowflake": {"account": "acc", "database": "D", "schema": "S", "warehouse": "W", "role": "R"},
    }
    options = jdbc.postgres_options(config)
    assert options["url"] == "jdbc:postgresql://db:5432/dwh"
    assert (options["user"], options["password"]) == ("u", "p")
    options = jdbc.snowflake_options(config, {"SNOWFLAKE_USER": "su", "SNOWFLAKE_PASSWORD": "sp"})
    assert options["url"] == "jdbc:snowflake://acc.snowflakecomputing.com/"
    assert (options["user"], options["password"], options["db"], options["role"]) == ("su", "sp", "D", "R")
    with pytest.raises(KeyError):
        jdbc.snowflake_options(config, {})


def test_a_local_warehouse_is_no_shared_folder_of_a_cluster(spark):
    class Session:
        """The session of a cluster that names no folder to share."""

        def __init__(self, settings, master):
            self.conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
            self.sparkContext = SimpleNamespace(master=master, _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc)

    local = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.shared_root(Session(local, "spark://host:7077"))
    assert files.shared_root(Session(local, "local[4]")) == "file:/tmp/warehouse"
    assert files.shared_root(Session(local | {"spark.checkpoint.dir": "file:/shared/"}, "yarn")) == "file:/shared"
