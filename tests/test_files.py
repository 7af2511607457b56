"""Records from files in parallel, published snapshots, out-of-fold scores."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewise.operators.baseline import fit_group_baseline, fit_group_baselines, fit_out_of_fold, fold_of
from pricewise.plans.context import Chain
from pricewise.plans.fixtures import SALE_KEY
from pricewise.sources import snapshots
from pricewise.sources.records import ends_inside, read_records, read_sales
from pricewise.sources.series import load_or_build_factors
from pricewise.sources.sinks import scratch_path


def random_file(path, seed, rows):
    rng = random.Random(seed)
    cells = ["a", "", "x y", 'say ""hi""', "1,5", "two\nlines", "three\r\nmore\n\nlines", '""', "é漢", "z" * 30, '5" tall', 'a"b"c']
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("h1,h2,h3,h4\r\n")
        for _ in range(rows):
            out = []
            for _ in range(rng.randrange(1, 6)):
                c = rng.choice(cells)
                quoted = rng.random() < 0.4 or any(x in c for x in ",\n\r") or c.startswith('"')
                out.append(f'"{c}"' + rng.choice(("", "", "tail")) if quoted and c not in ('5" tall', 'a"b"c') else c.replace("\n", " ").replace("\r", " "))
            f.write(",".join(out) + rng.choice(("\n", "\r\n")))
            if rng.random() < 0.05:
                f.write("\n")


@pytest.mark.parametrize("split", [61, 300, 5000])
def test_records_across_splits_equal_csv_reader(spark, tmp_path, split):
    want, header = [], []
    for i in range(2):
        p = tmp_path / f"f{i}.csv"
        random_file(p, i, 30)
        with open(p, newline="", encoding="utf-8") as f:
            rows = [r for r in csv.reader(f) if r]
        header += rows[:1]
        want += rows[1:]
    names = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        df = read_records(spark, str(tmp_path / "*.csv"))
        got = df.collect()
        pieces = df.select(F.regexp_extract("record_id", ":([0-9]+):", 1)).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # a logical record is one text; the csv module cuts it into the same fields
    fields = [next(csv.reader([r.line + "\r\n"] if "\n" not in r.line else (r.line + "\r\n").splitlines(keepends=True))) for r in got]
    assert sorted(fields) == sorted(want) and len({r.record_id for r in got}) == len(got)
    assert split == 5000 or pieces > 2       # starts of splits


def test_line_states():
    for line, out, inside in (("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('""', False, True), ('"a""', True, False),
                              ('x","y', True, True), (",\"", True, False), ('"a"b"c,d', False, True), ("", False, True)):
        assert ends_inside(line, False) == out, line
    assert ends_inside('x"', True) is False and ends_inside('x""', True) is True and ends_inside('x","y', True) is True


def test_open_record_at_the_end_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n1\n"open,\nstill')
    (tmp_path / "b.csv").write_text("h\n")
    (tmp_path / "c.csv").write_text("")
    got = sorted(r.line for r in read_records(spark, str(tmp_path / "*.csv")).collect())
    assert got == ['"open,\nstill', "1"]
    assert sorted(r.line for r in read_records(spark, str(tmp_path / "b.csv"), header=False).collect()) == ["h"]


def test_sales_from_a_file(spark, tmp_path):
    from pricewise.config import RAW_SALE_COLUMNS
    (tmp_path / "s.csv").write_text(",".join(RAW_SALE_COLUMNS) + "\n" + "2012,kia,rio,lx, sport,sedan" + ",x" * 11 + "\n"
                                    + '2013,kia,rio,"two\nlines",sedan' + ",x" * 11 + "\nbad,row\n")
    got = sorted((r.status, r.year, r.trim) for r in read_sales(spark, str(tmp_path)).collect())
    assert got == [("bad", None, None), ("ok", "2013", "two\nlines"), ("repaired", "2012", "lx, sport")]


def test_snapshots_with_a_reader_and_a_crash(spark):
    path = scratch_path(spark, "published")
    assert snapshots.manifest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path)
    one = snapshots.publish(spark.range(10).toDF("x"), path, rows=10)
    reader = snapshots.read_snapshot(spark, path)
    dead = snapshots.stage(spark.range(3).toDF("x"), path)           # a writer that dies before the swap
    assert snapshots.read_snapshot(spark, path).count() == 10 and snapshots.manifest(spark, path) == {"snapshot": one, "rows": 10}
    # a table may be replaced by what was read from it
    two = snapshots.publish(snapshots.read_snapshot(spark, path).withColumn("x", F.col("x") + 100), path)
    assert reader.agg(F.max("x")).first()[0] == 9                   # still the old content
    assert snapshots.read_snapshot(spark, path).agg(F.min("x")).first()[0] == 100
    assert sorted(snapshots.remove_old(spark, path, [one])) == [dead]
    assert reader.count() == 10
    assert snapshots.remove_old(spark, path, []) == [one] and snapshots.manifest(spark, path)["snapshot"] == two


def test_a_failed_build_is_not_read(spark):
    path = scratch_path(spark, "factors")
    good = Chain(spark, SF_SMALL).factors
    with pytest.raises(Exception, match="no such month"):
        from pricewise.functions.labels import check_month
        load_or_build_factors(spark, path, lambda: good.withColumn("sale_month", check_month(F.col("sale_month") + 1)))
    assert snapshots.manifest(spark, path) is None
    assert load_or_build_factors(spark, path, lambda: good).count() == good.count()
    assert load_or_build_factors(spark, path, lambda: 1 / 0).count() == good.count()


def test_out_of_fold_scores_never_saw_their_row(spark):
    frame = Chain(spark, SF_SMALL).frame.limit(800).persist()
    quick = fit_group_baselines(frame, SALE_KEY, 4)
    plain = fit_out_of_fold(frame, fit_group_baseline, SALE_KEY, 4)
    a, b = ({tuple(r[k] for k in SALE_KEY): r.prediction for r in m.transform(frame).collect()} for m in (quick, plain))
    assert a == pytest.approx(b) and len(a) == frame.count()
    rows = frame.withColumn("fold", fold_of(SALE_KEY, 4)).collect()
    for r in rows[:100]:
        other = [x.sellingprice for x in rows if x.fold != r.fold and (x.make, x.body) == (r.make, r.body)] or \
            [x.sellingprice for x in rows if x.fold != r.fold]
        assert a[tuple(r[k] for k in SALE_KEY)] == pytest.approx(sum(other) / len(other))


def test_segment_job_updates_the_record(spark):
    from pricewise.operators.evaluation import evaluate_segments
    from pricewise.operators.metrics import segment_metrics
    from pricewise.operators.split import split
    frame = Chain(spark, SF_SMALL).frame
    train, test = split(frame, SALE_KEY)
    model, record = fit_group_baseline(train), scratch_path(spark, "record")
    assert evaluate_segments(model, frame, SALE_KEY, record) is None
    snapshots.publish(spark.createDataFrame([("baseline", 7)], "model string, rows long"), record)
    for _ in range(2):          # the second time over the first result
        r = evaluate_segments(model, frame, SALE_KEY, record).first()
        assert (r.model, r.rows, r.metrics.n) == ("baseline", 7, test.count())
        want = sorted(tuple(x) for x in segment_metrics(model.transform(test)).collect())
        assert [tuple(x) for x in r.segment_metrics] == [pytest.approx(w) for w in want]
