import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from passante.plans import ingest as I
from passante.sources import csv_records as R
from tests.test_ingest_stream import FULL, _flow_file, _flow_line


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def random_file(seed, width, n):
    rnd = random.Random(seed)
    pool = ["", "a", "b c", "x,y", 'say "hi"', "two\nlines", "\n", "\n\nq", "é,\n\"\"", "{'a': 1, 'b': 2}", "long " * 30, "l\n" * 40, '"', '",', "1.5"]
    rows = [[f"h{k}" for k in range(width)], *([rnd.choice(pool) for _ in range(width - 1)] + [f"{seed}-{i}"] for i in range(n))]
    out = io.StringIO()
    csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"])).writerows(rows)
    return out.getvalue(), rows[1:]


def read(spark, path):
    return sorted((os.path.basename(r["_source_file"]), r["_width"], r["fields"]) for r in R.read_records(spark, path).collect())


@pytest.mark.parametrize("size", ["1m", "250b"])
def test_records_equal_an_encoder_whatever_the_splits(spark, tmp_dir, small_splits, size):
    want = []
    for k, (width, n) in enumerate([(3, 24), (5, 12), (2, 1), (4, 0)]):
        text, rows = random_file(k, width, n)
        write(f"{tmp_dir}/in/{k}.csv", text)
        want += [(f"{k}.csv", width, row) for row in rows]
    write(f"{tmp_dir}/in/empty.csv", "")
    small_splits(size)
    assert read(spark, f"{tmp_dir}/in") == sorted(want)


@pytest.mark.parametrize("size", ["1m", "23b"])
def test_odd_quotes_empty_lines_and_cut_off_files(spark, tmp_dir, small_splits, size):
    write(f"{tmp_dir}/in/a.csv", 'h,"i\nj",k\n\n\r\n5" pipe,"a "b" c",x\n"q""r",,\n"end",1,"cut\noff')
    write(f"{tmp_dir}/in/b.csv", "\n\nonly\n1\n")
    small_splits(size)
    assert read(spark, f"{tmp_dir}/in") == sorted([("a.csv", 3, ['5" pipe', 'a "b" c', "x"]), ("a.csv", 3, ['q"r', "", ""]), ("a.csv", 3, ["end", "1", "cut\noff"]),
                                                   ("b.csv", 1, ["1"])])


def test_each_file_has_its_own_header(spark, tmp_dir):
    _flow_file(f"{tmp_dir}/in/ten.csv", [_flow_line(k) for k in range(3)] + [_flow_line(9) + ",more"])
    write(f"{tmp_dir}/in/twelve.csv", "a,b,c,d,e,f,g,h,i,j,k,l\n" + "\n".join(_flow_line(k) + ",x,y" for k in range(5)) + "\n" + _flow_line(7) + "\n")
    write(f"{tmp_dir}/in/nine.csv", "a,b,c,d,e,f,g,h,i\n1,2,3,4,5,6,7,8,9\n")
    df = I.read_flow_csv(spark, f"{tmp_dir}/in")
    assert df.count() == 8 and df.where("target is null").count() == 0
    assert sorted(len(r.fields) for r in I.rejected_records(spark, f"{tmp_dir}/in").collect()) == [9, 10, 11]
    with pytest.raises(Exception, match="malformed record"):
        I.read_flow_csv(spark, f"{tmp_dir}/in", "bulk").collect()


def test_ids_and_rows_do_not_depend_on_splits(spark, tmp_dir, small_splits):
    def line(k):
        return _flow_line(k, FULL).replace("Rua", f'"Rua {k}\n"').replace(f'"Rua {k}\n" {k}', f'"Rua {k}\nfundos, ""B"""')

    _flow_file(f"{tmp_dir}/in/a.csv", [line(k % 150) for k in range(200)])
    found = {}
    for size in ("128m", "6k"):
        small_splits(size)
        I.load_csv(spark, f"{tmp_dir}/in", f"{tmp_dir}/wh{size}", "bulk")
        rows = spark.read.parquet(f"{tmp_dir}/wh{size}/geodata").select("id", "endereco", "location_id").collect()
        found[size] = sorted(map(tuple, rows))
    assert found["128m"] == found["6k"] and len(found["6k"]) == 200
    assert {r[1] for r in found["6k"]} == {f'Rua {k}\nfundos, "B"' for k in range(150)}
    assert spark.read.parquet(f"{tmp_dir}/wh6k/age").where(F.abs(F.col("x18_19") - 0.1) > 1e-9).count() == 0
