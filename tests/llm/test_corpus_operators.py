"""Operators that learn from or search the corpus, and the pipeline, against plain forms."""

import os
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from surtido.llm import bpe, common, decontamination, queries, simhash, suffixes, toxicity
from tests.llm import brute
from tests.llm.conftest import EDGES, FOLDER, sorted_rows

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def digests(docs, **options):
    return suffixes.remove_repeated(docs, **options).select(
        "row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long"),
        F.size("spans"), F.sha2("kept", 256))


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in rows.collect()]


def test_repeated_strings(spark, edges, empty, documents):
    assert sorted_rows(digests(edges), "*") == brute.repeated_bytes(EDGES)
    assert sorted_rows(queries.op7_suffix_dedup(spark, FOLDER), "*") == brute.repeated_bytes(
        documents)
    assert digests(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings_of_few_signs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab"[:1 + s % 2] + "é") for _ in range(300)) for s in range(4)]
    docs = []
    for i in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            text = rng.choice(base)
            a = rng.randrange(len(text))
            parts.append(text[a:a + rng.randrange(20, 120)])
        docs.append((rng.randrange(30), "".join(parts)))
    texts = {}
    docs = [(i, texts.setdefault(i, t)) for i, t in docs]
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 500)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted_rows(digests(df), "*") == brute.repeated_bytes(docs)
    assert sorted_rows(digests(df, width=37), "*") == brute.repeated_bytes(docs, 37)


def test_a_passage_in_many_documents_makes_no_large_block(spark, monkeypatch):
    rng = random.Random(9)

    def own(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    passage = own(200)
    docs = [(i % 280, own(rng.randrange(60)) + (passage + own(rng.randrange(3))) * rng.choice((1, 1, 2))
             + own(rng.randrange(60))) for i in range(280)] + [(None, passage), (300, "é" + passage)]
    whole = suffixes.shared_windows

    def bounded(parts, holders, width):
        if sum(map(len, parts)) > 3 * 2000:
            raise ValueError("a block is larger than its bound")
        return whole(parts, holders, width)

    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffixes, "LARGE_BYTES", 1000)
    monkeypatch.setattr(suffixes, "SAMPLE", 1, raising=False)
    monkeypatch.setattr(suffixes, "WINDOWS_AT_ONCE", 500, raising=False)
    monkeypatch.setattr(suffixes, "shared_windows", bounded)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted_rows(digests(df), "*") == brute.repeated_bytes(docs)


def shuffle_bytes(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = (f for top in disk.localDirsString() for d, _, names in os.walk(top)
             for f in (os.path.join(d, n) for n in names if n.startswith("shuffle_")))
    return sum(os.path.getsize(f) for f in files)


def test_no_segments_lie_on_disk_when_the_texts_are_shuffled(spark, tmp_path):
    rng = random.Random(6)
    texts = [rng.randbytes(20000).hex() for _ in range(20)]
    rows = [(i, texts[i % 20] + texts[i * 7 % 20][:5000]) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    before = shuffle_bytes(spark)
    found = suffixes.remove_repeated(docs)
    until = time.time() + 20
    # Of 1.8 MB of texts, by far less than their segments.
    while (left := shuffle_bytes(spark) - before) > 1e6 and time.time() < until:
        time.sleep(0.2)
    assert left < 1e6
    assert spark.conf.get(common.CLEAN_UP) == "false"
    assert sorted_rows(found.select("row.doc_id", F.octet_length("kept")), "*")[0][1] > 40000


def test_more_buckets_do_not_make_segments_compress_less():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
             for _ in range(3000)]
    rows = pa.RecordBatch.from_pydict({
        "doc_id": list(range(100)), "mark": [0] * 100,
        "text": [" ".join(rng.choices(words, k=1500)) for _ in range(100)]})
    none = np.zeros(0, np.uint64)
    for a_task in (1, 500):
        cuts = list(suffixes._segments(iter([rows]), 4, a_task, 50, none))
        packed = [p for c in cuts for p in c.column("packed").to_pylist() if p]
        assert len(packed) == 4
        read = [suffixes._unpack(*p.values()) for p in packed]
        n = sum(r[0].size for r in read)
        assert all((np.diff(r[0]) >= 0).all() and len(np.unique(r[0] // a_task)) == 1 for r in read)
        size = sum(len(p["data"]) for p in packed)
        if a_task == 1:
            first, segments = size, n
    assert n == segments and size < 1.2 * first


def test_the_largest_doc_id_is_a_document_like_any_other(spark):
    text = "a text of more than fifty bytes that several documents hold as a whole"
    docs = [(2 ** 63 - 1, text), (2 ** 63 - 2, text), (None, text), (0, "x" + text[9:] + "yz")]
    got = digests(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted_rows(got, "*") == brute.repeated_bytes(docs)


def test_parts_left_out_share_no_window():
    rng = random.Random(8)
    core = b"the minimizer 16"
    for width in (37, 50, 51):
        kept = 0
        for _ in range(60):
            sides = [bytes(rng.choice(b"ab") for _ in range(40)) for _ in range(3)]
            parts = sorted({(rng.choice(sides)[-rng.randrange(4, 40):] + core
                             + rng.choice(sides)[:rng.randrange(4, 40)]) for _ in range(6)})
            parts += [b"z" * 30 + core * 2]
            stays = suffixes._sides(parts, np.full(len(parts), suffixes._hashes(
                np.frombuffer(core, np.uint8))[0]), width)
            windows = [{w for i in range(len(p) - width + 1) if core in (w := p[i:i + width])}
                       for p in parts]
            for i, own in enumerate(windows):
                if any(own & w for j, w in enumerate(windows) if j != i):
                    assert stays[i]
            kept += stays.sum()
        assert kept < 60 * 7


def test_expansion_gives_common_prefixes():
    rng = random.Random(3)
    for width in (2, 5, 9):
        text = np.array([rng.randrange(1, 4) for _ in range(400)] + [0])
        order = suffixes._sort(text, width)
        bound = suffixes.expand(text, order, width)
        rows = [text[o:o + width].tolist() for o in order]
        assert bound.tolist() == [True] + [a != b for a, b in zip(rows, rows[1:])]


def plain_score(item: list[str], text: list[str]) -> float:
    best, above = 0.0, [0.0] * (len(text) + 1)
    for word in item:
        row = [0.0]
        for j, other in enumerate(text):
            row.append(max(0.0, above[j] + (1.0 if word == other else -1.0), above[j + 1] - 1.0,
                           row[j] - 1.0))
        above, best = row, max(best, *row)
    return best


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_alignment_equals_the_plain_matrix():
    rng = random.Random(4)
    for _ in range(200):
        item, text = (np.array([rng.randrange(5) for _ in range(rng.randrange(1, 14))])
                      for _ in range(2))
        score, start, stop = decontamination.align(item, text)
        assert score == plain_score(item.tolist(), text.tolist())
        assert score == plain_score(item.tolist(), text[start:stop].tolist())


def test_edited_copies_are_found(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(30)))
             for i in range(20)] + [(20, None), (21, "two words"), (22, "")]
    docs, want = [], set()
    for n in range(120):
        filler = [rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(rng.randrange(80))]
        if n % 3 == 0:
            item, copy = rng.randrange(20), None
            copy = items[item][1].split()
            for _ in range(n % 4):
                copy[rng.randrange(len(copy))] = "edited"
            if n % 2:
                del copy[rng.randrange(len(copy))]
            filler[len(filler) // 2:len(filler) // 2] = copy
            want.add((n, item))
        docs.append((n, " ".join(filler).upper()))
    docs += [(500, None), (501, ""), (None, items[3][1]), (0, docs[0][1])]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, matches string")
    its = spark.createDataFrame(items, "item_id long, text string")
    for at_once in (20_000, 7):
        found = decontamination.contaminated(df, its, items_at_once=at_once).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want | {(None, 3)}
        texts = dict(docs)
        for r in found:
            own = words(texts[r["doc_id"]])[r["start_word"]:r["stop_word"]]
            item = words(dict(items)[r["item_id"]])
            assert r["score"] == pytest.approx(plain_score(item, own) / len(item))
            assert decontamination.LEAST_SCORE <= r["score"] <= 1
        assert len(found) == len(want) + 2
    for none in (df.limit(0), ):
        assert decontamination.contaminated(none, its).count() == 0
    assert decontamination.contaminated(df, its.limit(0)).count() == 0


def plain_contaminated(docs, items):
    """(doc, item) of scores that reach the threshold, over all pairs that share enough words."""
    found = set()
    for i, text in docs:
        own = words(text)
        for item, passage in items:
            want = words(passage)
            if len(want) < 3 or sum(w in set(own) for w in want) < 0.6 * len(want):
                continue
            ids = {}
            a, b = (np.array([ids.setdefault(w, len(ids)) for w in x]) for x in (want, own))
            if decontamination.align(a, b)[0] >= decontamination.LEAST_SCORE * len(want):
                found.add((i, item))
    return found


def edited_copies(kinds, lengths):
    """(docs, items): per length and kind an item, and one document with a copy edited evenly."""
    items, docs = [], []
    for length in lengths:
        for kind, every in kinds:
            number = len(items)
            own = [f"w{number}x{k}" for k in range(length)]
            copy = []
            for k, word in enumerate(own, 1):
                change = k % every == 0 and k < length
                copy += (["edited"] if kind == "replace" else [word, "edited"]) if change else [word]
            items.append((number, " ".join(own)))
            docs.append((number, " ".join(["before it"] * 20 + copy + ["after it"] * 20)))
    return docs, items


def test_copies_edited_at_even_distances_are_found(spark):
    docs, items = edited_copies([("replace", 6), ("insert", 5), ("insert", 3), ("replace", 4),
                                 ("insert", 2)], (4, 5, 7, 8, 9, 10, 11, 16, 39, 59))
    want = plain_contaminated(docs, items)
    assert {(n, n) for n in range(len(items)) if len(items[n][1].split()) >= 16
            and n % 5 < 2} <= want
    for extra in ([], [(1000 + n, text) for n, text in items]):
        df = spark.createDataFrame(docs + extra, "doc_id long, text string")
        found = decontamination.contaminated(
            df, spark.createDataFrame(items, "item_id long, text string")).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want | {
            (i, i - 1000) for i, _ in extra}


def test_copies_edited_at_random_are_found():
    rng = random.Random(8)
    for least in (0.3, 0.6, 0.8):
        for _ in range(300):
            item = [rng.randrange(1, 40) for _ in range(rng.randrange(3, 45))]
            copy = []
            for word in item:
                kind = rng.random()
                copy += ([0] if kind < 0.12 else [] if kind < 0.18 else [word, 0]
                         if kind < 0.3 else [word])
            text = np.array([0] * rng.randrange(9) + copy + [0] * rng.randrange(9))
            data = decontamination._Items((1,), {}, (np.array(item),))
            found = list(decontamination._matches(
                text, list(data.texts), decontamination._seeds(data, least), least, {0}))
            score = decontamination.align(data.texts[0], text)[0]
            assert max([m[1] for m in found], default=0) == (
                score / len(item) if score >= least * len(item) else 0)


def test_seeds_are_the_rarest_that_every_copy_must_share(spark):
    rng = random.Random(12)
    items = [np.array([rng.randrange(1, 40) for _ in range(n)]) for n in (5, 12, 30, 30, 3)]
    data = decontamination._Items(tuple(range(5)), {}, tuple(items))
    seeds = decontamination._seeds(data, 0.6)
    counts = {int(g): rng.choice((0, 1, 2, 50)) for g in range(len(seeds.grams))}
    rows = [(i, i, [g for g, n in counts.items() if i < n]) for i in range(50)]
    hits = spark.createDataFrame([r for r in rows if r[2]], "k1 long, k2 long, grams array<int>")
    got = {}
    for r in decontamination.rare_seeds(hits, seeds).collect():
        got.setdefault(r.item, set()).add(r.gram)
    for item, words in enumerate(items):
        n, kept = decontamination.kept_grams(len(words), 0.6)
        own = np.searchsorted(seeds.grams, decontamination._codes(words, n)).tolist()
        rarest = sorted(own, key=lambda g: (counts[g], g))[:len(own) - kept + 1]
        assert got[item] == set(rarest)


def test_blocks_of_items_and_words_give_the_same(spark, monkeypatch):
    rng = random.Random(13)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(60)) for _ in range(30)]
    items = spark.createDataFrame([(i, t[5:140]) for i, t in enumerate(texts[:9])] + [(99, None)],
                                  "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)) * 2 + [(40, None), (41, "")],
                                 "doc_id long, text string").repartition(4)
    whole = sorted_rows(decontamination.contaminated(docs, items), "*")
    assert len({r[0] for r in whole}) == 9 and len(whole) == 18
    assert sorted_rows(decontamination.contaminated(docs, items, items_at_once=2), "*") == whole
    monkeypatch.setattr(decontamination, "_BITS", 3)  # words share numbers in the n-grams
    assert sorted_rows(decontamination.contaminated(docs, items), "*") == whole


def test_every_copy_in_a_document_is_found(spark):
    item = [f"w{k}" for k in range(20)]
    edited = item[:6] + ["edited"] + item[7:]
    items = [(1, " ".join(item)), (2, "Two words"), (3, "once"), (4, "--")]
    docs = [(1, ["x"] * 3 + item + ["x"] * 9 + edited + item + ["x"] * 200 + edited),
            (2, (item + ["x"]) * 40), (3, "two words, two other words: TWO WORDS once".split()),
            (4, (edited[3:] + ["x"]) * 25), (5, ["x"] * 30), (6, ["words", "two"])]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in docs], "doc_id long, text string")
    found = decontamination.contaminated(
        df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = sorted((r["doc_id"], r["item_id"], r["start_word"], r["stop_word"]) for r in found)
    assert got == sorted(
        [(1, 1, a, a + 20) for a in (3, 32, 52, 272)]
        + [(2, 1, 21 * n, 21 * n + 20) for n in range(40)]
        + [(3, 2, 0, 2), (3, 2, 5, 7), (3, 3, 7, 8)]
        + [(4, 1, 18 * n, 18 * n + 17) for n in range(25)])


def test_decontamination_of_all_documents(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(
        "item_id", "text").collect()]
    found = queries.op10_decontamination(spark, FOLDER).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == plain_contaminated(documents, items)


def test_toxicity_of_unlabelled_rows(spark):
    """Learns from three quarters of the labels and is judged on the rest."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = toxicity.learn(docs, labels.where(~held))
    rows = toxicity.predict(docs.join(labels.where(held).select("doc_id", "toxic"), "doc_id"),
                            model).select("row.toxic", F.col("p")[1].alias("p")).collect()
    truth = np.array([r["toxic"] == 1 for r in rows])
    said = np.array([r["p"] >= toxicity.LEAST_TOXIC for r in rows])
    assert said[truth].mean() > 0.9 and said[~truth].mean() < 0.02


def test_a_later_model_uses_the_earlier_category():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 3))
    first = (x[:, 0] + 0.1 * rng.normal(size=4000) > 0).astype(float)
    second = ((first > 0) ^ (rng.random(4000) < 0.05)).astype(float)
    labels = np.column_stack([first, second])
    labels[::7, 0] = np.nan
    weights = toxicity.fit_chain(x, labels, np.arange(4000) % toxicity.FOLDS)
    assert [len(w) for w in weights] == [4, 5] and weights[1][3] > 0.1
    p = toxicity._apply(x, weights)
    assert np.mean((p[1] > 0.5) == (second > 0)) > 0.9


def test_toxicity_edges(spark, edges, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (6, 0, 1), (6, 0, None), (9, None, 0), (None, 1, 1), (99, 1, 1), (10, 0, 1)],
        "doc_id long, quality int, toxic int")
    model = toxicity.learn(edges, labels)
    rows = toxicity.predict(edges, model).select("row.doc_id", "p").collect()
    assert len(rows) == len(EDGES) and all(0 <= v <= 1 for r in rows for v in r["p"])
    assert all(r["p"] == [0, 0] for r in rows if r["doc_id"] in (2, 3, 4))
    assert toxicity.predict(empty, model).count() == 0
    nothing = toxicity.learn(edges, labels.limit(0))
    assert {tuple(r["p"]) for r in toxicity.predict(edges, nothing).collect()} == {(0.0, 0.0)}
    assert toxicity.learn(empty, labels).features == ()


def test_one_of_each_group_stays(spark, edges, empty):
    kept = simhash.keep_one(edges)
    assert kept.schema == edges.schema
    names = {c for _, _, c in brute.simhash_components(EDGES)}
    # The two texts of document 11 are not near each other, so both stay.
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        [*names, 11], key=str)
    assert simhash.keep_one(empty).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    rows = [tuple(r) for r in docs.collect()]

    toxic = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert toxic.columns == columns
    flagged = {r["doc_id"] for r in queries.op3_toxicity(spark, FOLDER).where("toxic").collect()}
    rows = [r for r in rows if r[0] not in flagged]
    assert sorted_rows(toxic, "*") == sorted(rows, key=str)

    once = corpus_pipeline.drop_repeated_lines(spark, toxic, FOLDER)
    assert once.schema == docs.schema
    got = {r["doc_id"]: r for r in once.collect()}
    for (i, n, lost, sha) in brute.line_dedup([r[:2] for r in rows]):
        assert brute.sha(got[i]["text"].encode()) == sha
        assert not lost or got[i]["n_chars"] == len(got[i]["text"])
    rows = [(r[0], got[r[0]]["text"]) for r in rows]

    single = corpus_pipeline.drop_near_duplicates(spark, once, FOLDER)
    assert single.schema == docs.schema
    stay = {c for _, _, c in brute.simhash_components(rows)}
    rows = [r for r in rows if r[0] in stay]
    assert sorted_rows(single, "doc_id", "text") == sorted(rows, key=str)

    clean = corpus_pipeline.drop_contaminated(spark, single, FOLDER)
    assert clean.schema == docs.schema
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(
        "item_id", "text").collect()]
    bad = {i for i, _ in plain_contaminated(rows, items)}
    rows = [r for r in rows if r[0] not in bad]
    assert sorted_rows(clean, "doc_id", "text") == sorted(rows, key=str)

    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=dict(bpe.read_ranks(public_tokenizers.path(queries.RANKS))))
    got = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, clean, FOLDER).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, text in rows:
        assert list(got[i]["ids"]) == encoding.encode_ordinary(text)
        assert got[i]["decoded_sha256"] == brute.sha(text.encode())


def test_pipeline_on_edges(spark, edges, tmp_path):
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars")
    empty = spark.read.parquet(f"{FOLDER}/labels.parquet").limit(0)
    folder = str(tmp_path)
    empty.write.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() > 5
