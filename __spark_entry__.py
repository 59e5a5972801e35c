"""

Every query reads the given tables in full. Reviews are either ``conversations`` (product =
conversation, review = turn) or ``documents`` (product = source, review = document); points
are ``embeddings``. The file queries write what Spark derives from the tables to the shared
folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from plotweave.functions import first_segment, fixed_decimals, vector_add, vector_divide, vector_equal
from plotweave.operators import approximate as sketching
from plotweave.operators import counts as counting
from plotweave.operators import dense, sparse
from plotweave.operators import terms as texts
from plotweave.operators import tfidf as weighting
from plotweave.plans import flows
from plotweave import sources
from plotweave.session import split_size, stage, stage_path

try:
    from plotweave.llm import registry as _llm
except ImportError as missing:
    # Only the whole subpackage may be missing; anything else is a fault to show.
    if missing.name not in ("plotweave.llm", "corpus_pipeline"):
        raise
    _llm = None

STOP_WORDS = ["and", "das", "der", "des", "die", "les", "los", "que", "the", "una", "und", "with"]


# -- inputs ----------------------------------------------------------------------------


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.read_table(spark, f"{sf_dir}/conversations.parquet", spread=True)
    return texts.as_reviews(table, "conv_id", "turn")


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.read_table(spark, f"{sf_dir}/conversations.parquet", spread=True)
    return texts.as_reviews(table, "role", F.struct("conv_id", "turn"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.read_table(spark, f"{sf_dir}/documents.parquet", spread=True)
    return texts.as_reviews(table, "source", "doc_id")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.read_table(spark, f"{sf_dir}/embeddings.parquet")
    return table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def _tf(reviews: DataFrame, **options) -> DataFrame:
    return weighting.term_frequency(texts.review_term_counts(reviews), **options)


def _stored_tf(reviews: DataFrame) -> DataFrame:
    return stage(_tf(reviews), "tf")


def _stored_tfidf(reviews: DataFrame) -> DataFrame:
    return stage(weighting.tfidf(_stored_tf(reviews)), "tfidf")


def _long(vectors: DataFrame, *keys: str, digits: int = 6) -> DataFrame:
    exploded = vectors.select(*keys, F.posexplode("v").alias("dim", "value"))
    value = F.round(F.col("value").cast("double"), digits).alias("value")
    return exploded.select(*keys, F.col("dim").cast("long").alias("dim"), value)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- words -----------------------------------------------------------------------------


def tokenize(spark, sf_dir):
    return texts.tokenize(_documents(spark, sf_dir))


def stop_word_filter(spark, sf_dir):
    return texts.drop_stop_words(texts.tokenize(_documents(spark, sf_dir)), STOP_WORDS)


def synopsis_rule(spark, sf_dir):
    text = F.col("text")
    labelled = F.concat(F.lit(" SYNOPSIS :"), text, F.lit(": tail"))
    return _documents(spark, sf_dir).select(
        F.col("review_id").alias("doc_id"),
        first_segment(text).alias("plain"),
        first_segment(labelled).alias("labelled"),
    )


def word_count(spark, sf_dir):
    return counting.word_count(_documents(spark, sf_dir), STOP_WORDS)


def top_words(spark, sf_dir):
    return flows.corpus_top_words(_documents(spark, sf_dir), STOP_WORDS)


def max_counts(spark, sf_dir):
    per_source = texts.tokenize(_documents(spark, sf_dir)).groupBy("product_id", "term").count()
    return counting.max_counts(per_source)


# -- TF-IDF ----------------------------------------------------------------------------


def review_term_counts(spark, sf_dir):
    return texts.review_term_counts(_documents(spark, sf_dir), STOP_WORDS)


def term_frequency(spark, sf_dir):
    return _rounded(_tf(_conversations(spark, sf_dir)), "tf")


def term_frequency_all_reviews(spark, sf_dir):
    return _rounded(_tf(_documents(spark, sf_dir), denominator=weighting.ALL_REVIEWS), "tf")


def _loads(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """TF of the conversations, and the sketches of two loads of it that share products, merged."""
    tf = _stored_tf(_conversations(spark, sf_dir))
    of_first_half = F.col("product_id") % 3 < 2
    first, second = (stage(sketching.product_sketches(tf.where(x)), "sketches") for x in (of_first_half, F.col("product_id") % 3 > 0))
    return tf, sketching.merged_sketches(first, second)


def document_frequency_approximate(spark, sf_dir):
    """Document frequencies beside whether the estimate is within a tenth."""
    tf, sketches = _loads(spark, sf_dir)
    estimate = sketching.approximate_document_frequency(sketches).withColumnRenamed("df", "estimate")
    both = weighting.document_frequency(tf).join(estimate, "term", "left")
    return both.select("term", "df", (F.abs(F.col("estimate") - F.col("df")) <= F.col("df") / 10).alias("close"))


def product_count_approximate(spark, sf_dir):
    tf, sketches = _loads(spark, sf_dir)
    exact, estimate = weighting.product_count(tf), sketching.approximate_product_count(sketches)
    close = F.abs(F.col("estimate") - F.col("n_products")) <= F.col("n_products") / 10
    return exact.join(estimate.withColumnRenamed("n_products", "estimate")).select("n_products", close.alias("close"))


def term_dictionary(spark, sf_dir):
    return weighting.term_dictionary(_tf(_documents(spark, sf_dir)))


def product_count(spark, sf_dir):
    return weighting.product_count(_tf(_conversations(spark, sf_dir)))


def document_frequency(spark, sf_dir):
    return weighting.document_frequency(_tf(_conversations(spark, sf_dir)))


def tfidf(spark, sf_dir):
    return _rounded(weighting.tfidf(_stored_tf(_conversations(spark, sf_dir))), "tfidf")


def tfidf_by_source(spark, sf_dir):
    return _rounded(weighting.tfidf(_stored_tf(_documents(spark, sf_dir))), "tfidf")


def vector_coordinates(spark, sf_dir):
    return _rounded(flows.tfidf_vectors(_conversations(spark, sf_dir)).vectors, "tfidf")


def vector_dense(spark, sf_dir):
    tf = _stored_tf(_roles(spark, sf_dir))
    dictionary = stage(weighting.term_dictionary(tf), "dictionary")
    return _long(dense.vectorize(tf, dictionary, "tf"), "id")


# -- dense clustering ------------------------------------------------------------------


def _seeds(spark, sf_dir, k: int = 3) -> DataFrame:
    return dense.choose_centroids(_points(spark, sf_dir), k)


def centroid_distances(spark, sf_dir):
    points = _points(spark, sf_dir)
    return _rounded(dense.centroid_distances(points, _seeds(spark, sf_dir)), "distance")


def vector_arithmetic(spark, sf_dir):
    v = F.col("v").cast("array<double>")
    points = _points(spark, sf_dir).select("id", vector_divide(vector_add(v, v), F.lit(4.0)).alias("v"))
    return _long(points, "id")


def vector_equality(spark, sf_dir):
    """The points that equal a seed, component by component."""
    seeds = _seeds(spark, sf_dir).select("cluster_id", F.col("v").alias("c"))
    points = _points(spark, sf_dir).withColumn("v", F.col("v").cast("array<double>"))
    # Three seeds.
    return points.join(F.broadcast(seeds), vector_equal(F.col("v"), F.col("c"))).select("id", "cluster_id")


def choose_centroids(spark, sf_dir):
    return _rounded(_seeds(spark, sf_dir).select("cluster_id", "id", "min_distance"), "min_distance")


def assign(spark, sf_dir):
    return _rounded(dense.assign(_points(spark, sf_dir), _seeds(spark, sf_dir)), "distance")


def _one_update(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    seeds = _seeds(spark, sf_dir)
    assigned = dense.assign(_points(spark, sf_dir), seeds, with_vectors=True)
    return seeds, dense.update_centroids(assigned, seeds)


def update_centroids(spark, sf_dir):
    return _long(_one_update(spark, sf_dir)[1], "cluster_id", "size")


def convergence(spark, sf_dir):
    return _rounded(dense.converged(dense.centroid_shifts(*_one_update(spark, sf_dir))), "max_shift")


def _clustered(spark, sf_dir) -> dense.LloydResult:
    return dense.lloyd(_points(spark, sf_dir), _seeds(spark, sf_dir))


def lloyd_centroids(spark, sf_dir):
    return _long(_clustered(spark, sf_dir).centroids, "cluster_id")


def lloyd_pruned(spark, sf_dir):
    """The history of iterations that leave out comparisons which cannot matter."""
    result = dense.lloyd(_points(spark, sf_dir), _seeds(spark, sf_dir), prune=True)
    return _rounded(result.history.drop("v"), "shift", "cost")


def lloyd_continued(spark, sf_dir):
    """The history of a run that is ended after two turns and continued."""
    points, seeds, run = _points(spark, sf_dir), _seeds(spark, sf_dir), stage_path(spark, "run")
    dense.lloyd(points, seeds, max_iter=2, run=run)
    return _rounded(dense.lloyd(points, seeds, run=run).history.drop("v"), "shift", "cost")


def _groups(points: DataFrame, n: int) -> DataFrame:
    """The mean of the vectors with equal id modulo ``n``."""
    members = stage(points.select(F.pmod("id", F.lit(n)).cast("int").alias("cluster_id"), "v"), "groups")
    none = members.groupBy("cluster_id").agg(F.first("v").alias("v"))
    return stage(dense.update_centroids(members, none), "means")


def assign_in_blocks(spark, sf_dir):
    """The nearest of 90 centroids, of which driver and tasks hold 20 at a time at most."""
    points = _points(spark, sf_dir)
    budget = 20 * 8 * points.select(F.size("v")).first()[0]
    return _rounded(dense.assign(points, _groups(points, 90), budget=budget), "distance")


def choose_centroids_k12(spark, sf_dir):
    """Twelve picks from fewer passes."""
    return _rounded(_seeds(spark, sf_dir, 12).select("cluster_id", "id", "min_distance"), "min_distance")


def lloyd_history(spark, sf_dir):
    history = _clustered(spark, sf_dir).history.drop("v")
    return _rounded(history, "shift", "cost")


def lloyd_assignments(spark, sf_dir):
    return _rounded(_clustered(spark, sf_dir).assignments, "distance")


def seeds_from_file(spark, sf_dir):
    """Two picks written as a centroid file, read back, and carried on to four."""
    path = stage_path(spark, "first_seeds")
    sources.write_keyed_centroids(_seeds(spark, sf_dir, 2), path)
    chosen = dense.choose_centroids(_points(spark, sf_dir), 4, sources.read_keyed_centroids(spark, path))
    return _rounded(chosen.select("cluster_id", "id", "min_distance"), "min_distance")


# -- sparse clustering -----------------------------------------------------------------


def _coordinates(spark, sf_dir) -> DataFrame:
    return sparse.as_coordinates(_stored_tfidf(_conversations(spark, sf_dir)))


def choose_centroids_tfidf(spark, sf_dir):
    _, picks = sparse.choose_centroids_sparse(_coordinates(spark, sf_dir), 3)
    return _rounded(picks, "min_distance")


def seeds_from_file_tfidf(spark, sf_dir):
    """Two picks written as coordinates, read back, and carried on to four."""
    coordinates, path = _coordinates(spark, sf_dir), stage_path(spark, "first_seeds")
    sources.write_coordinate_centroids(sparse.choose_centroids_sparse(coordinates, 2)[0], path)
    _, picks = sparse.choose_centroids_sparse(coordinates, 4, sources.read_coordinate_centroids(spark, path))
    return _rounded(picks, "min_distance")


def assign_tfidf(spark, sf_dir):
    coordinates = _coordinates(spark, sf_dir)
    centroids, _ = sparse.choose_centroids_sparse(coordinates, 3)
    return _rounded(sparse.assign_sparse(coordinates, centroids), "distance")


def assign_tfidf_k40(spark, sf_dir):
    """The nearest of 40 centroids: the means of the conversations with equal id modulo 40."""
    coordinates = _coordinates(spark, sf_dir)
    groups = coordinates.select("id", F.pmod("id", F.lit(40)).cast("int").alias("cluster_id")).distinct()
    none = coordinates.select(F.lit(0).alias("cluster_id"), "term", "value").where("false")
    means = stage(sparse.update_sparse(coordinates, stage(groups, "groups"), none), "means")
    return _rounded(sparse.assign_sparse(coordinates, means), "distance")


def _products(spark, sf_dir, **options) -> sparse.SparseLloydResult:
    return flows.cluster_products(_stored_tfidf(_conversations(spark, sf_dir)), 3, **options)


def lloyd_tfidf(spark, sf_dir):
    return _rounded(_products(spark, sf_dir).centroids, "value")


def lloyd_tfidf_history(spark, sf_dir):
    return _rounded(_products(spark, sf_dir).history, "shift", "cost")


def lloyd_tfidf_continued(spark, sf_dir):
    """The history of a run on coordinates that is ended after its first turn and continued."""
    coordinates, run = sparse.stored_coordinates(_coordinates(spark, sf_dir)), stage_path(spark, "run")
    seeds, _ = sparse.choose_centroids_sparse(coordinates, 3)
    sparse.lloyd_sparse(coordinates, seeds, max_iter=1, run=run)
    return _rounded(sparse.lloyd_sparse(coordinates, seeds, run=run).history, "shift", "cost")


def lloyd_tfidf_assignments(spark, sf_dir):
    return _rounded(_products(spark, sf_dir).assignments, "distance")


# -- files -----------------------------------------------------------------------------


def _write_reviews(spark, sf_dir) -> str:
    """The documents as review blocks, every second one with a synopsis label."""
    path = stage_path(spark, "review_files")
    label = F.when(F.col("review_id") % 2 == 1, F.lit("Synopsis: ")).otherwise(F.lit(""))
    block = F.concat(
        F.lit("product/productId: "), F.col("product_id"), F.lit("\nreview/userId: u"),
        F.col("review_id").cast("string"), F.lit("\nreview/score: 4.0\nreview/text: "), label,
        F.regexp_replace("text", r"[\r\n]+", " "), F.lit("\n"),
    )
    _documents(spark, sf_dir).select(block).write.text(path)
    return path


def review_file_scan(spark, sf_dir):
    path = _write_reviews(spark, sf_dir)
    reviews = sources.read_reviews(spark, path, all_fields=True)
    return reviews.select("product_id", "user_id", "score", "text")


def review_line_scan(spark, sf_dir):
    path = _write_reviews(spark, sf_dir)
    return sources.read_review_lines(spark, path).select("product_id", "text")


def word_count_of_files(spark, sf_dir):
    return counting.word_count(sources.read_reviews(spark, _write_reviews(spark, sf_dir)))


def review_rejects(spark, sf_dir):
    """Every dropped text line of the files with defects, and why."""
    checked = sources.read_reviews_checked(spark, _write_defects(spark, sf_dir))
    return checked.rejected.select(F.col("product_id").alias("product"), "line", "reason")


def review_rejects_of_lines(spark, sf_dir):
    """The reviews and the dropped lines that the line-by-line reader tells apart, by product."""
    checked = sources.read_review_lines_checked(spark, _write_defects(spark, sf_dir))
    every = checked.reviews.select("product_id", F.lit(1).alias("kept")).unionByName(
        checked.rejected.select("product_id", F.lit(0).alias("kept"))
    )
    return every.groupBy(F.col("product_id").alias("product")).agg(
        F.sum("kept").alias("kept"), F.count_if(F.col("kept") == 0).alias("dropped")
    )


def small_splits(spark, sf_dir):
    """The conversations as review files, read in splits of 1 KB."""
    path = stage_path(spark, "review_files")
    label = F.when(F.col("review_id") % 2 == 0, F.lit("Synopsis: ")).otherwise(F.lit(""))
    block = F.concat(
        F.lit("product/productId: "), F.col("product_id").cast("string"), F.lit("\nreview/text: "), label,
        F.regexp_replace("text", r"[\r\n]+", " "), F.lit("\n"),
    )
    _conversations(spark, sf_dir).select(block).write.text(path)
    with split_size(spark, path, 1024):
        return stage(sources.read_reviews(spark, path).select("product_id", "text"), "small_splits")


def stop_word_file(spark, sf_dir):
    """The 1000 most frequent words as a stop-word file, applied to the corpus."""
    documents, path = _documents(spark, sf_dir), stage_path(spark, "stop_words")
    flows.corpus_top_words(documents).select(F.concat(F.lit(" "), "term", F.lit("\t"))).write.text(path)
    return counting.word_count(documents, sources.read_stop_words(spark, path))


def tf_file(spark, sf_dir):
    path = stage_path(spark, "tf_file")
    sources.write_triples(_tf(_conversations(spark, sf_dir)), path)
    return _rounded(sources.read_triples(spark, path, id_type="long"), "tf")


def tfidf_file(spark, sf_dir):
    path = stage_path(spark, "tfidf_file")
    scores = weighting.tfidf(_stored_tf(_conversations(spark, sf_dir)))
    sources.write_triples(scores, path, "tfidf")
    return _rounded(sources.read_triples(spark, path, "tfidf", "long"), "tfidf")


def dictionary_file(spark, sf_dir):
    path = stage_path(spark, "dictionary_file")
    sources.write_dictionary(weighting.term_dictionary(_tf(_conversations(spark, sf_dir))), path)
    return weighting.term_dictionary(sources.read_dictionary(spark, path))


def vector_file(spark, sf_dir):
    path = stage_path(spark, "vector_file")
    sources.write_vectors(_points(spark, sf_dir), path)
    return _long(sources.read_vectors(spark, path, "long"), "id")


def seed_file(spark, sf_dir):
    path = stage_path(spark, "seed_file")
    sources.write_keyed_centroids(_seeds(spark, sf_dir), path)
    return _long(sources.read_keyed_centroids(spark, path), "cluster_id")


def seed_file_distances(spark, sf_dir):
    """The distances that stand beside the picks in their file."""
    path = stage_path(spark, "seed_file")
    sources.write_keyed_centroids(_seeds(spark, sf_dir), path)
    return _rounded(sources.read_keyed_centroids(spark, path).select("cluster_id", "min_distance"), "min_distance")


def vectorize_file(spark, sf_dir):
    """Dense TF vectors of the roles, written and read back."""
    tf, path = _stored_tf(_roles(spark, sf_dir)), stage_path(spark, "vector_file")
    dictionary = stage(weighting.term_dictionary(tf), "dictionary")
    sources.write_vectors(dense.vectorize(tf, dictionary, "tf"), path)
    return _long(sources.read_vectors(spark, path), "id")


def top_words_file(spark, sf_dir):
    """The report of the most frequent words as it is written: lines in ascending order."""
    path = stage_path(spark, "top_words")
    best = flows.corpus_top_words(_documents(spark, sf_dir), STOP_WORDS)
    # A report of 1000 lines is one file.
    sources.write_word_counts(best.coalesce(1).sortWithinPartitions("count", "term"), path)
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    return lines.select("line", "value")


def centroid_file(spark, sf_dir):
    path = stage_path(spark, "centroid_file")
    sources.write_centroids(_one_update(spark, sf_dir)[1], path)
    return _long(sources.read_centroids(spark, path), "cluster_id", digits=5)


def centroid_folder(spark, sf_dir):
    """Vectors in many files of uneven size, numbered in the order of files and lines."""
    path = stage_path(spark, "centroid_folder")
    points = _points(spark, sf_dir).withColumn("v", F.col("v").cast("array<double>"))
    split = points.repartitionByRange(7, F.sqrt("id")).sortWithinPartitions("id")
    split.select(fixed_decimals(F.col("v"))).write.text(path)
    return _long(sources.read_centroids(spark, path), "cluster_id", digits=5)


def history_files(spark, sf_dir):
    path = stage_path(spark, "history_files")
    sources.write_history(_clustered(spark, sf_dir).history, path)
    return _long(sources.read_history(spark, path), "iteration", "cluster_id", "size")


def history_files_tfidf(spark, sf_dir):
    path = stage_path(spark, "history_files")
    sources.write_history(_products(spark, sf_dir).past_centroids, path)
    return _rounded(sources.read_history(spark, path), "value")


def centroid_file_tfidf(spark, sf_dir):
    """The final centroids on coordinates, with five decimals."""
    path = stage_path(spark, "centroid_file")
    sources.write_coordinate_centroids(_products(spark, sf_dir).centroids, path, digits=5)
    return sources.read_coordinate_centroids(spark, path)


def review_all_fields(spark, sf_dir):
    """All eight fields of a block."""
    path = stage_path(spark, "review_files")
    field = lambda key, value: F.concat(F.lit(f"\n{key}: "), value)
    number = F.col("review_id").cast("string")
    block = F.concat(
        F.lit("product/productId: "), F.col("product_id"), field("review/userId", F.concat(F.lit("u"), number)),
        field("review/profileName", F.concat(F.lit("name: "), number)), field("review/helpfulness", F.concat(number, F.lit("/9"))),
        field("review/score", F.lit("3.5")), field("review/time", number), field("review/summary", F.concat(F.lit(" about "), number)),
        field("review/text", F.regexp_replace("text", r"[\r\n]+", " ")), F.lit("\n"),
    )
    _documents(spark, sf_dir).select(block).write.text(path)
    reviews = sources.read_reviews(spark, path, text_rule="full", all_fields=True)
    return reviews.drop("review_id").withColumn("time", F.unix_timestamp("time"))


def review_defects(spark, sf_dir):
    """Texts per product, among them orphans, of files with every defect; and the dropped lines.

    Every product id heads two texts; of the ids that are multiples of 5 the product line has
    no value, of those of 7 the first text has none.
    """
    path = _write_defects(spark, sf_dir)
    malformed = Observation()
    reviews = stage(sources.read_reviews(spark, path, malformed=malformed), "reviews")
    counted = texts.review_term_counts(reviews).agg(F.sum("term_count").alias("kept_terms"))
    return reviews.agg(
        F.count("*").alias("texts"), F.count_if(F.col("product_id").isNull()).alias("orphans")
    ).withColumn("malformed", F.lit(malformed.get["malformed_lines"]).cast("long")).join(counted)


def _write_defects(spark, sf_dir) -> str:
    path = stage_path(spark, "review_files")
    text = F.regexp_replace("text", r"[\r\n]+", " ")
    block = F.concat(
        F.lit("product/productId:"), F.when(F.col("review_id") % 5 == 0, "").otherwise(F.concat(F.lit(" "), "product_id")),
        F.lit("\nreview/text"), F.when(F.col("review_id") % 7 == 0, "").otherwise(F.concat(F.lit(": "), text)),
        F.lit("\nreview/text: Synopsis: "), text, F.lit("\n"),
    )
    _documents(spark, sf_dir).select(block).write.text(path)
    return path


def files_to_clusters(spark, sf_dir):
    """The whole flow: review files, TF, TF-IDF, seeds, clusters; the clusters of the sources."""
    reviews = sources.read_reviews(spark, _write_reviews(spark, sf_dir))
    tables = flows.tfidf_vectors(reviews, STOP_WORDS)
    return _rounded(flows.cluster_products(tables.tfidf, 3).assignments, "distance")


def _many_stop_words(spark, sf_dir) -> DataFrame:
    """The 20,000 most frequent words of the corpus."""
    return stage(flows.corpus_top_words(_documents(spark, sf_dir), n=20_000), "stop_words").select("term")


def word_count_many_stop_words(spark, sf_dir):
    return counting.word_count(_documents(spark, sf_dir), _many_stop_words(spark, sf_dir))


def review_term_counts_many_stop_words(spark, sf_dir):
    return texts.review_term_counts(_documents(spark, sf_dir), _many_stop_words(spark, sf_dir))


def word_count_file(spark, sf_dir):
    path = stage_path(spark, "word_count_file")
    sources.write_word_counts(counting.word_count(_documents(spark, sf_dir)), path)
    return sources.read_word_counts(spark, path)


# -- contract --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """TF-IDF of the conversations at sf0.001."""
    return tfidf(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name; each takes (spark, sf_dir)."""
    return (_llm.queries() if _llm else {}) | {
        f.__name__: f
        for f in (
            tokenize, stop_word_filter, synopsis_rule, word_count, top_words, max_counts,
            review_term_counts, term_frequency, term_frequency_all_reviews, term_dictionary,
            product_count, document_frequency, tfidf, tfidf_by_source, vector_coordinates,
            vector_dense, centroid_distances, vector_arithmetic, vector_equality, choose_centroids, assign,
            update_centroids, convergence, lloyd_centroids, lloyd_history, lloyd_assignments,
            seeds_from_file, choose_centroids_tfidf, seeds_from_file_tfidf, assign_tfidf,
            assign_tfidf_k40, lloyd_tfidf, lloyd_tfidf_history, lloyd_tfidf_assignments,
            review_file_scan, review_line_scan, review_all_fields, review_defects,
            word_count_of_files, stop_word_file, word_count_many_stop_words,
            review_term_counts_many_stop_words, tf_file, tfidf_file, dictionary_file,
            vector_file, seed_file, centroid_file, centroid_folder, centroid_file_tfidf,
            history_files, history_files_tfidf, word_count_file, files_to_clusters,
            lloyd_pruned, lloyd_continued, lloyd_tfidf_continued, assign_in_blocks, choose_centroids_k12,
            document_frequency_approximate, product_count_approximate, review_rejects,
            review_rejects_of_lines, small_splits, seed_file_distances, vectorize_file, top_words_file,
        )
    }


# -- SQL twins -------------------------------------------------------------------------


def _kept_sql(table: str, product: str, review: str, text: str = "text", stop: bool = False) -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    keep = f"length(x) > 2 AND x NOT IN ({words})" if stop else "length(x) > 2"
    return (
        f"SELECT {product} AS product_id, {review} AS review_id, unnest(list_filter("
        f"regexp_split_to_array(lower({text}), '[^a-z]+'), lambda x: {keep})) AS term FROM {table}"
    )


_DOCUMENT_TERMS = _kept_sql("documents", "source", "doc_id")
_CONVERSATION_TERMS = _kept_sql("conversations", "conv_id", "turn")
_ROLE_TERMS = _kept_sql("conversations", "role", "(conv_id, turn)")


def _tf_ctes(terms: str, all_reviews: bool = False) -> str:
    """CTEs k, c, t, tf, df."""
    if all_reviews:
        tf = (
            "p AS (SELECT product_id, count(*) AS n FROM k GROUP BY ALL), "
            "tf AS MATERIALIZED (SELECT product_id, term, sum(c) / any_value(n) AS tf "
            "FROM c JOIN p USING (product_id) GROUP BY product_id, term)"
        )
    else:
        tf = (
            "tf AS MATERIALIZED (SELECT product_id, term, sum(c) / sum(tot) AS tf "
            "FROM c JOIN t USING (product_id, review_id) GROUP BY product_id, term)"
        )
    return (
        f"k AS MATERIALIZED ({terms}), "
        "c AS (SELECT product_id, review_id, term, count(*) AS c FROM k GROUP BY ALL), "
        "t AS (SELECT product_id, review_id, count(*) AS tot FROM k GROUP BY ALL), "
        f"{tf}, df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL)"
    )


def _tfidf_ctes(terms: str) -> str:
    """CTEs up to s(product_id, term, tfidf)."""
    return _tf_ctes(terms) + (
        ", s AS MATERIALIZED (SELECT product_id, term, tf * ln((SELECT count(DISTINCT product_id) FROM tf) "
        "/ (1.0 + df)) AS tfidf FROM tf JOIN df USING (term))"
    )


_DICTIONARY = (
    "dictionary AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index "
    "FROM (SELECT DISTINCT term FROM {}))"
)


def _seed_ctes(k: int = 3) -> str:
    """CTEs pt(id, v), c0..c<k-1>(cluster_id, id, v, d) and seeds."""
    ctes = [
        "pt AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)",
        "c0 AS MATERIALIZED (SELECT 0 AS cluster_id, id, v, NULL::DOUBLE AS d FROM pt ORDER BY id LIMIT 1)",
    ]
    for i in range(1, k):
        known = " UNION ALL ".join(f"SELECT v FROM c{j}" for j in range(i))
        ctes.append(
            f"c{i} AS MATERIALIZED (SELECT {i} AS cluster_id, id, any_value(pt.v) AS v, "
            f"min(list_distance(pt.v, q.v)) AS d FROM pt, ({known}) AS q GROUP BY id "
            "ORDER BY d DESC, id LIMIT 1)"
        )
    union = " UNION ALL ".join(f"SELECT * FROM c{i}" for i in range(k))
    return ", ".join(ctes) + f", seeds AS MATERIALIZED ({union})"


def _step_ctes(i: int, old: str) -> str:
    """CTEs a<i>(id, cluster_id, distance, v), m<i>(cluster_id, dim, x, n), s<i>(cluster_id, v)."""
    return (
        f"a{i} AS MATERIALIZED (SELECT pt.id, arg_min(q.cluster_id, (list_distance(pt.v, q.v), q.cluster_id)) AS cluster_id, "
        f"min(list_distance(pt.v, q.v)) AS distance, any_value(pt.v) AS v FROM pt, {old} AS q GROUP BY pt.id), "
        f"m{i} AS MATERIALIZED (SELECT cluster_id, dim - 1 AS dim, avg(x) AS x, count(*) AS n FROM "
        f"(SELECT cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM a{i}) GROUP BY ALL), "
        f"s{i} AS MATERIALIZED (SELECT cluster_id, list(x ORDER BY dim) AS v FROM m{i} GROUP BY cluster_id)"
    )


def _turns(n: int) -> str:
    steps = [_step_ctes(i, "seeds" if i == 1 else f"s{i - 1}") for i in range(1, n + 1)]
    return ", ".join([_seed_ctes(), *steps])


def _to_convergence() -> str:
    """CTEs up to h(iteration, cluster_id, v, size, shift, cost, moved): all turns until no
    centroid moves farther than 0.01, and last(cluster_id, v)."""
    assigned = (
        "SELECT pt.id, arg_min(q.cluster_id, (list_distance(pt.v, q.v), q.cluster_id)) AS cluster_id, "
        "min(list_distance(pt.v, q.v)) AS d, any_value(pt.v) AS v FROM pt, h AS q GROUP BY pt.id"
    )
    means = (
        "SELECT cluster_id, list(x ORDER BY dim) AS v, any_value(n) AS n, any_value(cost) AS cost FROM "
        "(SELECT cluster_id, dim, avg(x) AS x, count(*) AS n, sum(dd) AS cost FROM "
        f"(SELECT cluster_id, d * d AS dd, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM ({assigned})) "
        "GROUP BY cluster_id, dim) GROUP BY cluster_id"
    )
    return (
        f"{_seed_ctes()}, h AS (SELECT 0 AS iteration, cluster_id, v, 0::BIGINT AS size, 0.0::DOUBLE AS shift, "
        "0.0::DOUBLE AS cost, 1e300::DOUBLE AS moved FROM seeds UNION ALL SELECT *, max(shift) OVER () AS moved FROM "
        "(SELECT o.iteration + 1, o.cluster_id, coalesce(m.v, o.v), coalesce(m.n, 0), "
        "list_distance(o.v, coalesce(m.v, o.v)) AS shift, coalesce(m.cost, 0.0) FROM h AS o "
        f"LEFT JOIN ({means}) AS m ON m.cluster_id = o.cluster_id WHERE o.moved > 0.01)), "
        "last AS MATERIALIZED (SELECT cluster_id, v FROM h WHERE iteration = (SELECT max(iteration) FROM h))"
    )


def _sparse_distances(old: str) -> str:
    """Squared distances (id, cluster_id, d) of all points to old(cluster_id, term, value), each
    the sum of the squared differences over the terms of either."""
    return (
        "SELECT id, cluster_id, sum(e) AS d FROM ("
        f"SELECT i.id, q.cluster_id, (coalesce(s.tfidf, 0) - q.value) ** 2 AS e FROM {old} AS q CROSS JOIN ids AS i "
        "LEFT JOIN s ON s.product_id = i.id AND s.term = q.term UNION ALL "
        f"SELECT s.product_id, n.cluster_id, s.tfidf ** 2 FROM s CROSS JOIN (SELECT DISTINCT cluster_id FROM {old}) AS n "
        f"LEFT JOIN {old} AS q ON q.cluster_id = n.cluster_id AND q.term = s.term WHERE q.term IS NULL) GROUP BY ALL"
    )


def _nearest_sql(old: str) -> str:
    return (
        "SELECT id, arg_min(cluster_id, (d, cluster_id)) AS cluster_id, min(d) AS d FROM "
        f"({_sparse_distances(old)}) GROUP BY id"
    )


def _sparse_seeds(k: int = 3, terms: str = "") -> str:
    """CTEs s, ids, p0..p<k-1>(cluster_id, id, d), g<j>, the first j picks' coordinates, and sa<j>,
    the points' nearest ones."""
    ctes = [
        _tfidf_ctes(terms or _CONVERSATION_TERMS),
        "ids AS MATERIALIZED (SELECT DISTINCT product_id AS id FROM s)",
        "p0 AS MATERIALIZED (SELECT 0 AS cluster_id, min(product_id) AS id, NULL::DOUBLE AS d FROM s)",
    ]
    for i in range(1, k + 1):
        known = " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(i))
        ctes.append(
            f"g{i} AS MATERIALIZED (SELECT p.cluster_id, s.term, s.tfidf AS value FROM s JOIN ({known}) AS p ON p.id = s.product_id)"
        )
        ctes.append(f"sa{i} AS MATERIALIZED ({_nearest_sql(f'g{i}')})")
        if i < k:
            ctes.append(
                f"p{i} AS MATERIALIZED (SELECT {i} AS cluster_id, id, sqrt(d) AS d FROM sa{i} ORDER BY sa{i}.d DESC, id LIMIT 1)"
            )
    return ", ".join(ctes)


SPARSE_TURNS = 6


def _sparse_to_convergence(terms: str = "") -> str:
    """CTEs t<i>(cluster_id, term, value), n<i>(cluster_id, size, shift, cost) per turn, and
    done<i>(moved); a turn after the last one has no rows. Ends with last and la, its assignment."""
    ctes, old = [_sparse_seeds(3, terms), "done0 AS MATERIALIZED (SELECT 1e300 AS moved)"], "g3"
    for i in range(1, SPARSE_TURNS + 1):
        ctes += [
            f"w{i} AS MATERIALIZED (SELECT * FROM ({_nearest_sql(old)}) WHERE (SELECT moved FROM done{i - 1}) > 0.01)",
            f"z{i} AS MATERIALIZED (SELECT cluster_id, count(*) AS size, sum(d) AS cost FROM w{i} GROUP BY ALL)",
            f"t{i} AS MATERIALIZED (SELECT w.cluster_id, s.term, sum(s.tfidf) / any_value(z.size) AS value "
            f"FROM s JOIN w{i} AS w ON w.id = s.product_id JOIN z{i} AS z ON z.cluster_id = w.cluster_id "
            f"GROUP BY w.cluster_id, s.term UNION ALL SELECT o.* FROM {old} AS o WHERE EXISTS (FROM w{i}) "
            f"AND NOT EXISTS (FROM z{i} AS z WHERE z.cluster_id = o.cluster_id))",
            f"n{i} AS MATERIALIZED (SELECT cluster_id, any_value(coalesce(z.size, 0)) AS size, sqrt(sum(e)) AS shift, "
            f"any_value(coalesce(z.cost, 0)) AS cost FROM (SELECT coalesce(o.cluster_id, t.cluster_id) AS cluster_id, "
            f"(coalesce(o.value, 0) - coalesce(t.value, 0)) ** 2 AS e FROM {old} AS o FULL JOIN t{i} AS t "
            f"ON t.cluster_id = o.cluster_id AND t.term = o.term WHERE EXISTS (FROM w{i})) "
            f"LEFT JOIN z{i} AS z USING (cluster_id) GROUP BY cluster_id)",
            f"done{i} AS MATERIALIZED (SELECT coalesce(max(shift), 0) AS moved FROM n{i})",
        ]
        old = f"t{i}"
    numbers = " UNION ALL ".join(f"SELECT {i} AS iteration, * FROM t{i}" for i in range(1, SPARSE_TURNS + 1))
    ctes += [
        f"past AS MATERIALIZED ({numbers})",
        "last AS MATERIALIZED (SELECT cluster_id, term, value FROM past WHERE iteration = (SELECT max(iteration) FROM past))",
        f"la AS MATERIALIZED ({_nearest_sql('last')})",
    ]
    return ", ".join(ctes)


_TRIM = r"regexp_replace({}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_ONE_LINE = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"
_FILE_TEXT = _TRIM.format(f"split_part({_ONE_LINE}, ':', 1)")


def _first_segment_sql(text: str) -> str:
    first, second = f"split_part({text}, ':', 1)", f"split_part({text}, ':', 2)"
    label = _TRIM.format(first)
    return _TRIM.format(f"CASE WHEN lower({label}) = 'synopsis' THEN {second} ELSE {first} END")


def _long_sql(relation: str, keys: str, digits: int = 6) -> str:
    return (
        f"SELECT {keys}, CAST(dim - 1 AS BIGINT) AS dim, round(value, {digits}) AS value FROM "
        f"(SELECT {keys}, unnest(v) AS value, generate_subscripts(v, 1) AS dim FROM {relation})"
    )


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB's SQL, by query name."""
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    stopped = _kept_sql("documents", "source", "doc_id", stop=True)
    counted = f"SELECT term, count(*) AS count FROM ({stopped}) GROUP BY term"
    all_counted = f"SELECT term, count(*) AS count FROM ({_DOCUMENT_TERMS}) GROUP BY term"
    tf = _tf_ctes(_CONVERSATION_TERMS)
    tf_rows = "SELECT product_id, term, round(tf, 6) AS tf FROM tf"
    tfidf_rows = "SELECT product_id, term, round(tfidf, 6) AS tfidf FROM s"
    label = "' SYNOPSIS :' || text || ': tail'"
    sparse_history = " UNION ALL ".join(
        f"SELECT {i} AS iteration, cluster_id, size, round(shift, 6) AS shift, round(cost, 6) AS cost FROM n{i}"
        for i in range(1, SPARSE_TURNS + 1)
    )
    lloyd, lloyd_sparse = f"WITH RECURSIVE {_to_convergence()}", f"WITH {_sparse_to_convergence()}"
    ranked = f"SELECT term, count, row_number() OVER (ORDER BY count DESC, term DESC) AS place FROM ({all_counted})"
    stops = f"q AS MATERIALIZED (SELECT term FROM ({ranked}) WHERE place <= {{}})"
    groups = (
        "pt AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), "
        "q AS MATERIALIZED (SELECT cluster_id, list(x ORDER BY dim) AS v FROM (SELECT CAST(id % 90 AS INTEGER) AS cluster_id, dim, "
        "avg(x) AS x FROM (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM pt) GROUP BY ALL) GROUP BY cluster_id)"
    )
    seeds = " UNION ALL ".join(f"SELECT cluster_id, id, d FROM c{i}" for i in range(12))
    conversation_text = _TRIM.format(r"split_part(regexp_replace(text, '[\r\n]+', ' ', 'g'), ':', 1)")
    dropped = "doc_id % 7 = 0"
    product = "CASE WHEN doc_id % 5 <> 0 THEN source END"
    not_stopped = f"SELECT k.* FROM ({_DOCUMENT_TERMS}) AS k ANTI JOIN q ON q.term = k.term"
    file_kept = _kept_sql("documents", "source", "doc_id", _FILE_TEXT, stop=True)
    one_line = f"{_ONE_LINE}"
    return (_llm.oracles() if _llm else {}) | {
        "tokenize": _DOCUMENT_TERMS,
        "stop_word_filter": f"SELECT * FROM ({_DOCUMENT_TERMS}) WHERE term NOT IN ({words})",
        "synopsis_rule": f"SELECT doc_id, {_first_segment_sql('text')} AS plain, "
        f"{_first_segment_sql(f'({label})')} AS labelled FROM documents",
        "word_count": counted,
        "top_words": f"SELECT * FROM ({counted}) ORDER BY count DESC, term DESC LIMIT 1000",
        "max_counts": "SELECT term, greatest(max(n), 0) AS count FROM "
        f"(SELECT product_id, term, count(*) AS n FROM ({_DOCUMENT_TERMS}) GROUP BY ALL) GROUP BY term",
        "review_term_counts": f"WITH {_tf_ctes(stopped)} SELECT product_id, review_id, term, c AS term_count, "
        "tot AS total_count FROM c JOIN t USING (product_id, review_id)",
        "term_frequency": f"WITH {tf} {tf_rows}",
        "term_frequency_all_reviews": f"WITH {_tf_ctes(_DOCUMENT_TERMS, True)} {tf_rows}",
        "term_dictionary": f"WITH {_DICTIONARY.format(f'({_DOCUMENT_TERMS})')} SELECT * FROM dictionary",
        "product_count": f"WITH {tf} SELECT count(DISTINCT product_id) AS n_products FROM tf",
        "document_frequency": f"WITH {tf} SELECT term, df FROM df",
        "tfidf": f"WITH {_tfidf_ctes(_CONVERSATION_TERMS)} {tfidf_rows}",
        "tfidf_by_source": f"WITH {_tfidf_ctes(_DOCUMENT_TERMS)} {tfidf_rows}",
        "vector_coordinates": f"WITH {_tfidf_ctes(_CONVERSATION_TERMS)}, {_DICTIONARY.format('tf')} "
        "SELECT product_id, term_index, round(tfidf, 6) AS tfidf FROM s JOIN dictionary USING (term)",
        "vector_dense": f"WITH {_tf_ctes(_ROLE_TERMS)}, {_DICTIONARY.format('tf')} "
        "SELECT p.id, CAST(term_index AS BIGINT) AS dim, round(coalesce(tf, 0), 6) AS value FROM "
        "(SELECT DISTINCT product_id AS id FROM tf) AS p CROSS JOIN dictionary AS d "
        "LEFT JOIN tf ON tf.product_id = p.id AND tf.term = d.term",
        "centroid_distances": f"WITH {_seed_ctes()} SELECT pt.id, cluster_id, "
        "round(list_distance(pt.v, seeds.v), 6) AS distance FROM pt, seeds",
        "vector_arithmetic": "SELECT id, CAST(dim - 1 AS BIGINT) AS dim, round((value + value) / 4.0, 6) AS value FROM "
        "(SELECT vec_id AS id, unnest(embedding::DOUBLE[]) AS value, generate_subscripts(embedding, 1) AS dim FROM embeddings)",
        "vector_equality": f"WITH {_seed_ctes()} SELECT pt.id, cluster_id FROM pt JOIN seeds ON pt.v = seeds.v",
        "choose_centroids": f"WITH {_seed_ctes()} SELECT cluster_id, id, round(d, 6) AS min_distance FROM seeds",
        "assign": f"WITH {_turns(1)} SELECT id, cluster_id, round(distance, 6) AS distance FROM a1",
        "update_centroids": f"WITH {_turns(1)} SELECT cluster_id, n AS size, CAST(dim AS BIGINT) AS dim, round(x, 6) AS value FROM m1",
        "convergence": f"WITH {_turns(1)} SELECT round(max(d), 6) AS max_shift, max(d) <= 0.01 AS converged FROM "
        "(SELECT list_distance(seeds.v, s1.v) AS d FROM seeds JOIN s1 USING (cluster_id))",
        "lloyd_centroids": f"{lloyd} SELECT cluster_id, dim, round(value, 6) AS value FROM ({_long_sql('last', 'cluster_id', 12)})",
        "lloyd_history": f"{lloyd} SELECT iteration, cluster_id, size, round(shift, 6) AS shift, round(cost, 6) AS cost FROM h WHERE iteration > 0",
        "lloyd_assignments": f"{lloyd} SELECT pt.id, arg_min(q.cluster_id, (list_distance(pt.v, q.v), q.cluster_id)) AS cluster_id, "
        "round(min(list_distance(pt.v, q.v)), 6) AS distance FROM pt, last AS q GROUP BY pt.id",
        "seeds_from_file": f"WITH {_seed_ctes(4)} SELECT cluster_id, CASE WHEN cluster_id > 1 THEN id END AS id, "
        "CASE WHEN cluster_id > 1 THEN round(d, 6) END AS min_distance FROM seeds",
        "choose_centroids_tfidf": f"WITH {_sparse_seeds()} SELECT cluster_id, id, round(d, 6) AS min_distance FROM "
        "(SELECT * FROM p0 UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2)",
        "seeds_from_file_tfidf": f"WITH {_sparse_seeds(4)} SELECT cluster_id, CASE WHEN cluster_id > 1 THEN id END AS id, "
        "CASE WHEN cluster_id > 1 THEN round(d, 6) END AS min_distance FROM "
        "(SELECT * FROM p0 UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)",
        "assign_tfidf": f"WITH {_sparse_seeds()} SELECT id, cluster_id, round(sqrt(d), 6) AS distance FROM sa3",
        "assign_tfidf_k40": f"WITH {_tfidf_ctes(_CONVERSATION_TERMS)}, ids AS MATERIALIZED (SELECT DISTINCT product_id AS id FROM s), "
        "sizes AS (SELECT CAST(id % 40 AS INTEGER) AS cluster_id, count(*) AS size FROM ids GROUP BY ALL), "
        "g AS MATERIALIZED (SELECT z.cluster_id, s.term, sum(s.tfidf) / any_value(z.size) AS value FROM s "
        "JOIN sizes AS z ON z.cluster_id = s.product_id % 40 GROUP BY z.cluster_id, s.term) "
        f"SELECT id, cluster_id, round(sqrt(d), 6) AS distance FROM ({_nearest_sql('g')})",
        "lloyd_tfidf": f"{lloyd_sparse} SELECT cluster_id, term, round(value, 6) AS value FROM last",
        "lloyd_tfidf_history": f"{lloyd_sparse} {sparse_history}",
        "lloyd_tfidf_assignments": f"{lloyd_sparse} SELECT id, cluster_id, round(sqrt(d), 6) AS distance FROM la",
        "review_file_scan": f"SELECT source AS product_id, 'u' || doc_id AS user_id, 4.0::DOUBLE AS score, {_FILE_TEXT} AS text FROM documents",
        "review_line_scan": f"SELECT source AS product_id, {_FILE_TEXT} AS text FROM documents",
        "review_all_fields": "SELECT source AS product_id, 'u' || doc_id AS user_id, 'name: ' || doc_id AS profile_name, "
        "doc_id || '/9' AS helpfulness, 3.5::DOUBLE AS score, doc_id AS time, 'about ' || doc_id AS summary, "
        f"{_TRIM.format(one_line)} AS text FROM documents",
        "review_defects": "SELECT count(*) AS texts, count(*) FILTER (doc_id % 5 = 0) AS orphans, "
        "(SELECT count(*) FROM documents WHERE doc_id % 7 = 0) AS malformed, "
        "CAST(sum(len(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: length(x) > 2))) "
        "FILTER (doc_id % 5 <> 0) AS BIGINT) AS kept_terms FROM "
        f"(SELECT doc_id, {_FILE_TEXT} AS text FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, {_FILE_TEXT} FROM documents)",
        "word_count_of_files": "SELECT term, count(*) AS count FROM "
        f"({_kept_sql('documents', 'source', 'doc_id', _FILE_TEXT)}) GROUP BY term",
        "stop_word_file": f"SELECT term, count FROM ({ranked}) WHERE place > 1000",
        "word_count_many_stop_words": f"SELECT term, count FROM ({ranked}) WHERE place > 20000",
        "review_term_counts_many_stop_words": f"WITH {stops.format(20000)}, {_tf_ctes(not_stopped)} "
        "SELECT product_id, review_id, term, c AS term_count, CAST(tot AS BIGINT) AS total_count FROM c JOIN t USING (product_id, review_id)",
        "tf_file": f"WITH {tf} {tf_rows}",
        "tfidf_file": f"WITH {_tfidf_ctes(_CONVERSATION_TERMS)} {tfidf_rows}",
        "dictionary_file": f"WITH {_DICTIONARY.format(f'({_CONVERSATION_TERMS})')} SELECT * FROM dictionary",
        "vector_file": "WITH p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings) " + _long_sql("p", "id"),
        "seed_file": f"WITH {_seed_ctes()} " + _long_sql("seeds", "cluster_id"),
        "centroid_file": f"WITH {_turns(1)} " + _long_sql("s1", "cluster_id", 5),
        "centroid_folder": "WITH p AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster_id, embedding::DOUBLE[] AS v FROM embeddings) "
        "SELECT CAST(cluster_id AS INTEGER) AS cluster_id, dim, value FROM (" + _long_sql("p", "cluster_id", 5) + ")",
        "centroid_file_tfidf": f"{lloyd_sparse} SELECT cluster_id, term, round(value, 5) AS value FROM last",
        "history_files": f"{lloyd} " + _long_sql("(SELECT * FROM h WHERE iteration > 0)", "iteration, cluster_id, size"),
        "history_files_tfidf": f"{lloyd_sparse} SELECT iteration, cluster_id, term, round(value, 6) AS value FROM past",
        "files_to_clusters": f"WITH {_sparse_to_convergence(file_kept)} SELECT id, cluster_id, round(sqrt(d), 6) AS distance FROM la",
        "word_count_file": all_counted,
        "lloyd_pruned": f"{lloyd} SELECT iteration, cluster_id, size, round(shift, 6) AS shift, round(cost, 6) AS cost FROM h WHERE iteration > 0",
        "lloyd_continued": f"{lloyd} SELECT iteration, cluster_id, size, round(shift, 6) AS shift, round(cost, 6) AS cost FROM h WHERE iteration > 0",
        "lloyd_tfidf_continued": f"{lloyd_sparse} {sparse_history}",
        "assign_in_blocks": f"WITH {groups} SELECT pt.id, arg_min(q.cluster_id, (list_distance(pt.v, q.v), q.cluster_id)) AS cluster_id, "
        "round(min(list_distance(pt.v, q.v)), 6) AS distance FROM pt, q GROUP BY pt.id",
        "choose_centroids_k12": f"WITH {_seed_ctes(12)} SELECT cluster_id, id, round(d, 6) AS min_distance FROM ({seeds})",
        "document_frequency_approximate": f"WITH {tf} SELECT term, df, true AS close FROM df",
        "product_count_approximate": f"WITH {tf} SELECT count(DISTINCT product_id) AS n_products, true AS close FROM tf",
        "review_rejects": f"SELECT {product} AS product, 'review/text' AS line, 'no value' AS reason FROM documents WHERE {dropped}",
        "review_rejects_of_lines": f"SELECT {product} AS product, count(*) + count(*) FILTER (NOT ({dropped})) AS kept, "
        f"count(*) FILTER ({dropped}) AS dropped FROM documents GROUP BY ALL",
        "small_splits": f"SELECT conv_id::VARCHAR AS product_id, {conversation_text} AS text FROM conversations",
        "seed_file_distances": f"WITH {_seed_ctes()} SELECT cluster_id, round(coalesce(d, 0), 6) AS min_distance FROM seeds",
        "vectorize_file": f"WITH {_tf_ctes(_ROLE_TERMS)}, {_DICTIONARY.format('tf')} "
        "SELECT p.id, CAST(term_index AS BIGINT) AS dim, round(coalesce(tf, 0), 6) AS value FROM "
        "(SELECT DISTINCT product_id AS id FROM tf) AS p CROSS JOIN dictionary AS d "
        "LEFT JOIN tf ON tf.product_id = p.id AND tf.term = d.term",
        "top_words_file": "SELECT row_number() OVER (ORDER BY count, term) - 1 AS line, term || chr(9) || count AS value FROM "
        f"(SELECT * FROM ({counted}) ORDER BY count DESC, term DESC LIMIT 1000)",
    }
