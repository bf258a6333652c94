import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from ledgerflow.config import TRANSACTION_LOG_COLUMN_MAP as MAP
from ledgerflow.sources import csv_blocks, tabs
from ledgerflow.sources.tabs import UnknownHeaderError, read_tab_export

HEADERS = list(MAP)[:4]
TARGETS = [MAP[h] for h in HEADERS]


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")
    yield use
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def cells(seed, n=60):
    rng = random.Random(seed)
    kinds = ["plain", "", "a,b", 'say "hi"', "two\nlines", "many\n\n\nlines, with \"quotes\"\n" * 3, '"', '""', "\n", "x" * 150, "\n".join("word" for _ in range(60)), 'é\n日本', "tail\r\nafter"]
    return [[rng.choice(kinds) for _ in HEADERS] for _ in range(n)]


def write(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(HEADERS)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


def one_task(spark, path):
    """Spark's multi-line reader."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path))
    return sorted(tuple(r[h] or "" for h in HEADERS) for r in df.collect())


def read(spark, path):
    return sorted(tuple(r[t] for t in TARGETS) for r in read_tab_export(spark, str(path), MAP).collect())


@pytest.mark.parametrize("block", [23, 150, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_cells_across_block_borders(spark, tmp_path, small_blocks, block, end):
    rows = [r for r in cells(block, 20) if any(r)]
    path = tmp_path / "log.csv"
    write(path, rows, end)
    small_blocks(block)
    records = csv_blocks.read_records(spark, str(path))
    if block < 100:
        assert csv_blocks._lines(spark, str(path)).rdd.getNumPartitions() > 20
        assert csv_blocks.open_blocks(csv_blocks._lines(spark, str(path)))
    assert records.count() == len(rows) + 1 and records.where("first").count() == 1
    got = read(spark, path)
    assert got == sorted(tuple(r) for r in rows)
    if end == "\n":
        small_blocks(1 << 20)
        assert got == one_task(spark, path)


def test_state_scan_equals_a_walk_over_characters():
    def walk(text, quoted):
        state = "in" if quoted else "start"
        for ch in text:
            if state == "in":
                state = "shut" if ch == '"' else "in"
            elif state == "shut":
                state = "in" if ch == '"' else "start" if ch == "," else "bare"
            elif state == "start":
                state = "in" if ch == '"' else "start" if ch == "," else "bare"
            elif ch == ",":
                state = "start"
        return state == "in"

    rng = random.Random(1)
    for _ in range(20000):
        line = "".join(rng.choice('",a ') for _ in range(rng.randint(0, 9)))
        for quoted in (False, True):
            assert csv_blocks.quoted_after(line, quoted) == walk(line, quoted), (line, quoted)


def test_folder_of_files_bare_quotes_and_an_open_end(spark, tmp_path, small_blocks):
    write(tmp_path / "a.csv", [["1", "2\n3", "", ""]])
    write(tmp_path / "b.csv", [["4", "5", "", ""], ["6", "7\n\n8", "9", ""]])
    (tmp_path / "c.csv").write_text(",".join(f'"{h}"' for h in HEADERS) + '\n5" pipe,x,y,z\n"never\nclosed, at all\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n" + ",".join(HEADERS) + "\n\n7,,,\n")
    small_blocks(11)
    assert read(spark, tmp_path) == sorted([("1", "2\n3", "", ""), ("4", "5", "", ""), ("6", "7\n\n8", "9", ""), ('5" pipe', "x", "y", "z"),
                                            ("never\nclosed, at all", "", "", ""), ("7", "", "", "")])


def test_a_file_with_another_header_stops_the_load(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "2", "3", "4"]])
    (tmp_path / "b.csv").write_text(",".join(reversed(HEADERS)) + "\n4,3,2,1\n")
    with pytest.raises(PySparkException, match="differs from the first"):
        read(spark, tmp_path)


def test_empty_file_and_header_only(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert read(spark, tmp_path / "none.csv") == []
    write(tmp_path / "head.csv", [])
    assert read(spark, tmp_path / "head.csv") == []


def test_unknown_json_key_far_down_stops_the_load(spark, tmp_path):
    good = ['{"Timestamp": "t%d"}' % i for i in range(1000)]
    (tmp_path / "bad.json").write_text("\n".join([*good, '{"Timestamp": "x", "Surprise": 1}']))
    with pytest.raises(UnknownHeaderError, match="Surprise"):
        read_tab_export(spark, str(tmp_path / "bad.json"), MAP, "json", "log")
    (tmp_path / "late.json").write_text("\n".join([*good, '{" Remarks ": "kept"}', '{"Remarks": "too"}', '{"": 5}']))
    rows = read_tab_export(spark, str(tmp_path / "late.json"), MAP, "json").collect()
    assert len(rows) == 1003 and {r.remarks for r in rows} == {"", "kept", "too"}


def test_a_record_is_parsed_once_however_many_cells_are_looked_at(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Effective From Date,Vendor Name,Remarks\n2026-06-01,Ravi," x"\n,,\n2026-06-02,"a, b",\n')
    df = tabs.clean_cells(tabs.read_tab_export(spark, str(tmp_path / "t.csv"), {"Effective From Date": "effective_from", "Vendor Name": "vendor_name", "Remarks": "remarks"}))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert sorted(map(tuple, df.collect())) == [("2026-06-01", "Ravi", "x"), ("2026-06-02", "a, b", "")]
