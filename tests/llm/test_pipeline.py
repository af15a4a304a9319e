import corpus_pipeline
import pytest
from awkward import AWKWARD
from pyspark.sql import functions as F

from carelens.llm import decontaminate, quality
from carelens.llm.queries import queries
from carelens.llm.store import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """What each stage kept, beginning with the documents."""
    frames = [table(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), name.replace(" ", "-")))
    return frames


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_columns(kept):
    assert all(frame.columns == COLUMNS for frame in kept[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "best-fit packing"


def test_quality_keeps_what_it_scores_well(spark, sf_dir, kept):
    scores = quality.quality_scores(kept[0], table(spark, sf_dir, "labels"))
    assert ids(kept[1]) == sorted(r.doc_id for r in scores.where("predicted = 1").collect())
    labelled = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    good = {r.doc_id for r in labelled.where("quality = 1").collect()}
    assert good <= set(ids(kept[1]))


def test_lines_go_documents_stay(kept):
    assert ids(kept[2]) == ids(kept[1])
    before = {r.doc_id: r.text for r in kept[1].collect()}
    changed = [r for r in kept[2].collect() if r.text != before[r.doc_id]]
    assert changed and all(r.n_chars == len(r.text) for r in kept[2].collect())
    assert all(set(r.text.split("\n")) <= set(before[r.doc_id].split("\n")) | {""} for r in changed)


def test_one_of_each_group_stays(kept):
    """Groups are what pairs of a Jaccard similarity of 0.8 connect, by the exact five-word shingles of all pairs."""
    rows = sorted((r.doc_id, r.text) for r in kept[2].collect())
    sets = []
    for _, text in rows:
        words = text.lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders, label = {}, list(range(len(rows)))
    for i, own in enumerate(sets):
        for shingle in own or {()}:
            holders.setdefault(shingle, []).append(i)
    links = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in sorted(links):
        both = len(sets[a] & sets[b])
        if label[a] != label[b] and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    assert ids(kept[3]) == [rows[i][0] for i in sorted(set(label))]
    assert len(ids(kept[3])) < len(rows)


def test_contaminated_documents_go(spark, sf_dir, kept):
    hits = decontaminate.benchmark_hits(kept[3], table(spark, sf_dir, "benchmark"))
    assert ids(kept[4]) == sorted(r.doc_id for r in hits.where("n_hit = 0").collect())
    assert len(ids(kept[4])) < len(ids(kept[3]))


def test_all_that_is_left_is_packed(kept):
    assert {r.doc_id for r in kept[5].collect()} == set(ids(kept[4]))
    sequences = kept[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert sequences[0] <= 1024


def test_run_is_the_stages(spark, sf_dir, kept):
    own = queries()["pipeline"](spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert own.exceptAll(kept[5].select(own.columns)).isEmpty() and own.count() == kept[5].count()


def test_awkward_documents(spark, sf_dir):
    """Every stage takes any texts, also after the one before left none."""
    frame = spark.createDataFrame(AWKWARD, "doc_id long, text string").selectExpr(
        "*", "CAST(NULL AS STRING) AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars"
    )
    for start in (frame, frame.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, start, sf_dir)
            rows = out.count()
            assert rows <= 3 * len(AWKWARD) or "piece" in out.columns
