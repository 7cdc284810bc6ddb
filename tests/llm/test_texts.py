"""Line rules, classifiers, fingerprints and near-duplicates against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import components, line_rules, quality, queries, simhash, syncmers, toxicity
from tallyhouse.llm.common import keep
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NATIVE = ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct", "NestedLoop")


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in NATIVE)


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if often[gram] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeat = len(words), len(covered)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_line_rules(spark, sf_dir, documents, odd, nothing):
    made = queries.op2_quality_rules(spark, sf_dir)
    assert native(made)
    rows = {r.doc_id: r for r in made.collect()}
    assert all(tuple(rows[i][n] for n in NAMES) == counts(t) for i, t in documents) and len(rows) == len(documents)
    assert not any(r.kept and r.base_failed for r in rows.values())
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(known[i], r.kept) for i, r in rows.items() if i in known and not r.base_failed]
    assert all(kept == bool(good) for good, kept in judged)
    got = Counter(tuple(r[n] for n in NAMES) for r in line_rules.clean_lines(odd).collect())
    assert got == Counter(counts(t) for _, t in ODD)
    assert line_rules.clean_lines(nothing).count() == 0 and line_rules.keep_clean(nothing).columns == nothing.columns


def test_lines_go_and_columns_stay(spark):
    prose = "\n".join("Then " + " ".join(f"word{i}q{j}" for j in range(12)) + "." for i in range(6))
    bad = "Home | News | Sports | Shop | Jobs\nBUY NOW BUY NOW\nRead more and subscribe to us\nfoo### bar$$$ baz%%%\nwow!! so!! much!!"
    docs = spark.createDataFrame([(1, "x", prose + "\n" + bad + "\n" + prose, 1), (2, "y", bad * 30, 2)], "doc_id int, row string, text string, n_chars int")
    kept = line_rules.keep_clean(docs).collect()
    assert [(r.doc_id, r.row, r.text, r.n_chars) for r in kept] == []  # every window is repeated: base rules reject it
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 1, F.lit(prose + "\n" + bad)).otherwise(F.col("text")))
    kept = line_rules.keep_clean(docs).collect()
    assert [(r.doc_id, r.row, r.text, r.n_chars) for r in kept] == [(1, "x", prose, len(prose))]


def test_furniture_in_four_languages(spark):
    bad = ["All Rights Reserved.", "ALLE Rechte vorbehalten, 2024", "Zum Impressum", "Tous droits réservés", "Voir les conditions d\u2019utilisation", "CONDITIONS D'UTILISATION du site",
           "Mentions Légales", "Política de Privacidad", "Leer más en la portada", "Hier klicken und weiterlesen"]
    good = ["Alle rechten Winkel sind gleich.", "Les droits des enfants sont connus.", "Los derechos de los niños.", "Reserved seats were all taken.", "word " + " ".join(f"w{i}" for i in range(40)) + " impressum"]
    rows = spark.createDataFrame([(x,) for x in bad + good], "line string")
    got = {r.line: r.good for r in rows.select("line", line_rules.good_line(F.col("line")).alias("good")).collect()}
    assert [got[x] for x in bad] == [False] * len(bad) and [got[x] for x in good] == [True] * len(good)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7])
def test_repeats_in_short_texts(spark, n):
    text = " ".join("ab"[i % 2] for i in range(n))
    assert spark.range(1).select(line_rules.repeat_words(line_rules.words_of(F.lit(text)))).first()[0] == counts(text)[4]


def test_quality(spark, sf_dir, odd, nothing, labels):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op6_quality_classifier(spark, folder).collect()
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert quality.classify(odd, labels).count() == len(ODD)
    assert quality.classify(nothing, labels).count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_quality_learns_nothing_from_held_out_rows(spark, sf_dir):
    docs, known = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    made = keep(quality.features(docs), "features")
    a, b = (quality.fit(made, x) for x in (known, turned))
    assert np.allclose(a.means, b.means) and (a.sizes == b.sizes).all()


def test_discriminant_is_the_formula():
    rng = np.random.default_rng(5)
    x = [rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (200, 3))]
    model = quality.shrunk(np.array([300.0, 200.0]), np.stack([v.sum(0) for v in x]), np.stack([v.T @ v for v in x]))
    logs = [-0.5 * (np.einsum("ij,jk,ik->i", x[0] - m, np.linalg.inv(c), x[0] - m) + np.linalg.slogdet(c)[1]) for m, c in zip(model.means, model.covariances)]
    want = 1 / (1 + np.exp(-(quality.TEMPER * (logs[1] - logs[0]) + np.log(201 / 301))))
    assert np.allclose(model.scores(x[0]), want)


def test_toxicity(spark, sf_dir, odd, nothing, labels):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op3_toxicity(spark, folder).collect()
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    tested = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in tested) >= 0.85 * len(tested)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    same = {}
    for r in toxicity.classify(odd, labels.limit(0)).collect():
        same.setdefault(r.score, []).append(r)
    assert list(same) == [0.5] and len(same[0.5]) == len(ODD)
    assert toxicity.classify(nothing, labels).count() == 0


def test_gradients_and_windows():
    texts = ["alpha beta gamma delta " * 12, "one two", "", "x y z " * 20]
    trainer = toxicity.Trainer(texts, np.array([1, 0, 0, 1]))
    assert sorted(set(trainer.owner)) == [0, 1, 2, 3]
    for n in (0, 1, 32, 33, 48, 49, 500):
        covered = {int(s) + i for s in toxicity.window_starts(n) for i in range(toxicity.WINDOW)}
        assert covered >= set(range(n))
    chosen, wanted = np.arange(len(trainer.at)), trainer.labels[trainer.owner]

    def loss():
        q = toxicity.sigmoid(trainer.all_logits())
        return -np.mean(np.log(np.where(wanted == 1, q, 1 - q)))

    before = loss()
    for _ in range(30):
        trainer.step(chosen, wanted)
    assert loss() < 0.2 * before


def test_toxicity_reads_odd_texts(odd):
    trainer = toxicity.Trainer([f"good fine nice text {i}" if i % 2 else f"vile foul mean text {i}" for i in range(40)], np.arange(40) % 2)
    network = trainer.run()
    network.name = "test"
    rows = toxicity.score(odd, network).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1


def test_fingerprints(spark, sf_dir, documents):
    made = queries.op4_fingerprints(spark, sf_dir)
    assert native(made)
    rows = sorted(made.collect(), key=lambda r: r.doc_id)
    ordered = sorted(documents)
    prints = {}
    for n, ((i, text), r) in enumerate(zip(ordered, rows, strict=True)):
        q = len(text) // 4
        edited = text[: len(text) - q] + ordered[(n + 1) % len(ordered)][1][:q]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(prints.values())) == len(prints)
    assert np.median([r.near_edited for r in rows]) > 0.6 and np.median([r.near_next for r in rows]) < 0.05


def test_next_rows_and_odd_texts(spark, odd, nothing):
    rows = spark.createDataFrame([(int(x), str(x)) for x in np.random.default_rng(1).permutation(500)], "key long, text string").repartition(7)
    for size in (1, 10, 1000):
        led = {r.key: r.next_text for r in syncmers.with_next(rows, "key", ["text"], bucket_rows=size, max_buckets=90).collect()}
        assert led == {x: str((x + 1) % 500) for x in range(500)}
    made = syncmers.edited_pairs(odd).collect()
    assert len(made) == len(ODD) and sorted(r.n_chars for r in made) == sorted(len(t or "") for _, t in ODD)
    assert syncmers.edited_pairs(nothing).count() == 0
    one = syncmers.edited_pairs(odd.filter("doc_id = 8")).first()
    assert one.near_next == 1.0 and one.edited.startswith("One two")
    empty = syncmers.edited_pairs(odd.filter("doc_id in (1, 2)")).collect()
    assert all(r.near_next == r.near_edited == 1.0 and not r["sketch"] for r in empty)


def test_anchors_are_context_free(spark):
    passage = " ".join(f"w{i * i % 97}" for i in range(60))
    texts = [passage, "other words before it " + passage, passage + " and some more after it"]
    sketches = [{x >> 32 for x in r[0]} for r in spark.createDataFrame([(t,) for t in texts], "t string").select(syncmers.sketch(F.col("t"))).collect()]
    assert all(len(sketches[0] & s) >= 0.9 * len(sketches[0]) for s in sketches)


def plain_simhash(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    label = {f: f for f in prints}
    values = np.array(sorted(label), dtype=np.uint64)
    close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    links = simhash.merge(np.arange(len(values)), close[:, 0], close[:, 1])
    return {int(v): int(k) for v, k in zip(values, links)}


def test_simhash_query(spark, sf_dir, documents, odd, nothing):
    rows = {r.doc_id: r for r in queries.op5_simhash(spark, sf_dir).collect()}
    prints = {i: plain_simhash(t) for i, t in documents}
    group, least = plain_groups(prints.values()), {}
    for i, f in prints.items():
        least[group[f]] = min(i, least.get(group[f], i))
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{f:016x}", least[group[f]]) for i, f in prints.items()}
    got = simhash.near_duplicates(odd).collect()
    assert sorted(r.fingerprint for r in got) == sorted(f"{plain_simhash(t):016x}" for _, t in ODD)
    assert {r.component_id for r in got if r.doc_id in (5, 8)} == {5}
    assert simhash.near_duplicates(nothing).count() == 0
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([5, 1, None, 9, 4, 7, 10])
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_bit_slices_match_plain_distances(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, size=12, dtype=np.uint64)
    values = base[rng.integers(0, 12, 700)]
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)) * rng.integers(0, 2, 700).astype(np.uint64)
    values = np.unique(values)
    close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    want = simhash.merge(np.arange(len(values)), close[:, 0], close[:, 1])
    assert (simhash.linked_in_group(values, 2) == want).all()
    assert (simhash.linked_in_groups(values, np.zeros(len(values)), 2) == want).all()
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for tile in (16, 4096):  # with and without tiles
        found = {r.vertex: r.root for r in components.components(simhash.links(frame, tile=tile)).collect()}
        named = [found.get(int(v), int(v)) for v in values.view(np.int64)]
        assert len(set(zip(named, want.tolist()))) == len(set(named)) == len(set(want.tolist()))


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200), (300, 310), (310, 305), (500, 400), (500, 401)]
    found = {r.vertex: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100, 305: 300, 310: 300, 401: 400, 500: 400}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
