import pytest
from pyspark.sql import Observation

import __spark_entry__
from plotweave.session import split_size
from plotweave.sources import (
    read_centroids,
    read_keyed_centroids,
    read_review_lines,
    read_review_lines_checked,
    read_reviews,
    read_reviews_checked,
    read_stop_words,
    read_triples,
    read_vectors,
    read_word_counts,
)

FIELDS = [
    "review/userId: u1",
    "review/profileName: A: B",
    "review/helpfulness: 1/2",
    "review/score: 4.0",
    "review/time: 1323043200",
    "review/summary: fine",
]


def block(product, *texts):
    return [f"product/productId: {product}", *FIELDS, *[f"review/text: {t}" for t in texts]]


BLOCKS = [
    block("P1", "Space robots fight; robots win."),
    block("P1:cut", "first: second part"),
    block("P2", "Synopsis: Love story in Paris"),
    block("P3", "one", "two"),
    block("P4", "Synopsis"),
    ["product/productId:", "review/text: no product here"],
    ["product/productId: P5", "review/text:", ":", "review/textual: no", "xreview/text: no"],
    block("P6", "café  au  lait\x85still this line"),
]
EXPECTED = [
    ("P1", "Space robots fight; robots win."),
    ("P1", "first"),
    ("P2", "Love story in Paris"),
    ("P3", "one"),
    ("P3", "two"),
    (None, "no product here"),
    ("P6", "café  au  lait\x85still this line"),
]


def layouts():
    compact = "\n\n".join("\n".join(b) for b in BLOCKS) + "\n"
    spaced = "\n\n".join("\n\n".join(b) for b in BLOCKS) + "\n"
    return {
        "compact": compact,
        "spaced": spaced,
        "crlf": compact.replace("\n", "\r\n"),
        "no_last_newline": compact.rstrip("\n"),
        "leading_blank": "\n\n" + compact,
    }


def found(reviews):
    rows = reviews.collect()
    assert len({r.review_id for r in rows}) == len(rows)
    return sorted(((r.product_id, r.text) for r in rows), key=str)


@pytest.mark.parametrize("layout", list(layouts()))
@pytest.mark.parametrize("reader", [read_reviews, read_review_lines])
def test_layouts(spark, tmp_path, layout, reader):
    (tmp_path / "r.txt").write_bytes(layouts()[layout].encode())
    assert found(reader(spark, str(tmp_path))) == sorted(EXPECTED, key=str)


def test_bare_carriage_returns(spark, tmp_path):
    (tmp_path / "r.txt").write_bytes(layouts()["compact"].replace("\n", "\r").encode())
    assert found(read_reviews(spark, str(tmp_path), line_break="\r")) == sorted(EXPECTED, key=str)


@pytest.mark.parametrize("reader", [read_reviews, read_review_lines])
def test_text_before_any_product(spark, tmp_path, reader):
    (tmp_path / "a.txt").write_text("review/text: early bird\n\n" + "\n".join(block("P1", "x")))
    (tmp_path / "b.txt").write_text("\n".join(block("P2", "y")))
    assert found(reader(spark, str(tmp_path))) == [("P1", "x"), ("P2", "y"), (None, "early bird")]


@pytest.mark.parametrize("reader", [read_reviews, read_review_lines])
def test_malformed_lines_are_counted(spark, tmp_path, reader):
    (tmp_path / "r.txt").write_text(layouts()["compact"])
    seen = Observation()
    assert reader(spark, str(tmp_path), malformed=seen).count() == len(EXPECTED)
    assert seen.get["malformed_lines"] == 2  # a bare synopsis label and an empty text


@pytest.mark.parametrize("reader", [read_reviews, read_review_lines])
def test_full_text(spark, tmp_path, reader):
    (tmp_path / "r.txt").write_text(
        "\n".join(block("P1", "a: b: c") + block("P2", "SYNOPSIS : x: y") + block("P3", "Synopsis"))
    )
    assert found(reader(spark, str(tmp_path), text_rule="full")) == [
        ("P1", "a: b: c"),
        ("P2", "x: y"),
        ("P3", "Synopsis"),
    ]
    with pytest.raises(ValueError):
        reader(spark, str(tmp_path), text_rule="other")


def test_all_fields(spark, tmp_path):
    (tmp_path / "r.txt").write_text("\n".join(block("P1", "x")))
    row = read_reviews(spark, str(tmp_path), all_fields=True).first()
    assert (row.user_id, row.profile_name, row.helpfulness) == ("u1", "A: B", "1/2")
    assert (row.score, row.summary) == (4.0, "fine")
    assert row.time.year == 2011


@pytest.mark.parametrize("reader", [read_reviews, read_review_lines])
def test_records_across_splits(spark, tmp_path, reader):
    blocks = [block(f"P{i:05d}", f"text number {i} " + "word " * (i % 60)) for i in range(2000)]
    blocks[700] = ["product/productId: HOT"] + [f"review/text: hot {i}" for i in range(3000)]
    (tmp_path / "r.txt").write_text("\n\n".join("\n".join(b) for b in blocks))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        reviews = reader(spark, str(tmp_path))
        rows = found(reviews)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [
        (b[0].split(": ")[1], line.split(": ", 1)[1].strip())
        for b in blocks
        for line in b
        if line.startswith("review/text")
    ]
    assert len(rows) == 4999
    assert rows == sorted(expected, key=str)


def test_stop_words_are_trimmed(spark, tmp_path):
    (tmp_path / "s.txt").write_bytes(b"the\r\n\tmiss \n")
    assert [r.term for r in read_stop_words(spark, str(tmp_path)).collect()] == ["the", "miss"]


def test_short_lines_are_dropped(spark, tmp_path):
    (tmp_path / "t.txt").write_text('P1\tlove\t2.0E-4\nP1\tlove\nP1\tx\tnot a number\nP"2\tq"\t1\n')
    rows = read_triples(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("P1", "love", 0.0002), ('P"2', 'q"', 1.0)]
    assert read_word_counts(spark, str(tmp_path)).count() == 0


def test_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a\t1.0 2.0E-4 \nb\nc\t1.0 x\nd\t0 3 \n")
    assert [tuple(r) for r in read_vectors(spark, str(tmp_path)).collect()] == [
        ("a", [1.0, 0.0002]),
        ("d", [0.0, 3.0]),
    ]
    (tmp_path / "w.txt").write_text("0.0\t1.0 1.0\n2.5\t3.0 4.0\n")
    assert sorted(tuple(r) for r in read_keyed_centroids(spark, str(tmp_path)).collect()) == [
        (0, [1.0, 0.0002], None),
        (1, [0.0, 3.0], None),
        (2, [1.0, 1.0], 0.0),
        (3, [3.0, 4.0], 2.5),
    ]


def test_unkeyed_centroids(spark, tmp_path):
    (tmp_path / "c.txt").write_text("1.00000 2.00000 \n0.50000 0.00000 \n")
    assert [tuple(r) for r in read_centroids(spark, str(tmp_path)).collect()] == [
        (0, [1.0, 2.0]),
        (1, [0.5, 0.0]),
    ]


@pytest.mark.parametrize("reader", [read_reviews_checked, read_review_lines_checked])
@pytest.mark.parametrize("split", ["128m", "100"])
def test_dropped_lines_are_listed(spark, tmp_path, reader, split):
    """Also with splits of 100 bytes; the reviews are those of the plain reader."""
    (tmp_path / "r.txt").write_text(layouts()["compact"])
    (tmp_path / "s.txt").write_text("product/productId: P9\nreview/text\nreview/text: Synopsis:\nreview/text: kept\n")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, split)
    try:
        checked = reader(spark, str(tmp_path))
    finally:
        spark.conf.set(setting, before)
    assert found(checked.reviews) == sorted([*EXPECTED, ("P9", "kept")], key=str)
    rows = checked.rejected.collect()
    dropped = sorted((r.file.rsplit("/", 1)[1], r.product_id, r.line, r.reason) for r in rows)
    assert dropped == [
        ("r.txt", "P4", "review/text: Synopsis", "no text"), ("r.txt", "P5", "review/text:", "no value"),
        ("s.txt", "P9", "review/text", "no value"), ("s.txt", "P9", "review/text: Synopsis:", "no text"),
    ]
    starts = {r.block_start for r in rows}
    assert starts == {0} if split == "128m" else len(starts) > 1


def test_nothing_is_dropped_from_nothing(spark, tmp_path):
    (tmp_path / "r.txt").write_text("")
    checked = read_reviews_checked(spark, str(tmp_path))
    assert checked.reviews.collect() == [] and checked.rejected.collect() == []


def test_small_splits_are_dealt_to_few_tasks(spark, tmp_path):
    """Several hundred splits, a text in each; the settings are as before afterwards."""
    rows = [(f"P{i}", "word " * 190) for i in range(400)]
    path = str(tmp_path / "reviews")
    lines = [f"product/productId: {p}\nreview/text: {t}" for p, t in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    with split_size(spark, path, 1024):
        read = read_reviews(spark, path)
        tasks = read.rdd.getNumPartitions()
        splits = spark.read.text(path).select("_metadata.file_name", "_metadata.file_block_start").distinct().count()
        found = {r.product_id: r.text for r in read.collect()}
    assert [spark.conf.get(n, None) for n in names] == before
    assert splits > 300 and tasks <= 6 * spark.sparkContext.defaultParallelism < splits
    assert found == {p: t.strip() for p, t in rows}


def test_query_of_small_splits_has_few_tasks(spark, tmp_path):
    rows = [(i, 0, "user", "word " * 190) for i in range(400)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    read = __spark_entry__.small_splits(spark, str(tmp_path))
    assert read.count() == 400
    assert len(read.inputFiles()) <= 6 * spark.sparkContext.defaultParallelism


def test_text_rule_is_applied_once(spark, tmp_path):
    """No filter repeats it, and texts that it drops are counted."""
    (tmp_path / "r.txt").write_text("product/productId: P\nreview/text: Synopsis: a\nreview/text:\nreview/text: Synopsis\n")
    path, malformed = str(tmp_path / "r.txt"), Observation()
    reviews = read_reviews(spark, path).select("product_id", "text")
    plan = reviews._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count(" = synopsis") == 1
    assert [r.text for r in reviews.collect()] == ["a"]
    assert read_reviews(spark, path, malformed=malformed).count() == 1
    assert malformed.get["malformed_lines"] == 2
