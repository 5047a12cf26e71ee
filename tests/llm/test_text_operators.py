"""Operators on texts against plain forms: on edge cases, and on all rows of the tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zlib
from pyspark.sql import functions as F

from surtido.llm import bpe, langid, lines, quality, queries, sharding, simhash, warc
from tests.llm import brute
from tests.llm.conftest import EDGES, FOLDER, sorted_rows


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    return [tuple(r) for r in rows.collect()]


def test_quality_measures(spark, edges, empty, documents):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for got, rows in ((quality.score(edges), EDGES),
                      (queries.op5_quality_rules(spark, FOLDER), [d[:2] for d in documents])):
        want = sorted(((i, *(brute.quality(t)[n] for n in names)) for i, t in rows), key=str)
        assert sorted_rows(got, "doc_id", *names) == want
        assert got.where("base_failed AND kept").count() == 0
    assert quality.score(empty).count() == 0


def test_repeated_words_overlap(spark):
    words = "a b c d e f g h".split()
    for text in (words * 2, words + ["x"] + words[:7], words + words[1:] + words, ["z"] * 30):
        df = spark.createDataFrame([(1, " ".join(text))], "doc_id int, text string")
        assert quality.score(df).first()["n_repeat_words"] == brute.quality(
            " ".join(text))["n_repeat_words"]


def test_quality_plan_has_no_python_and_no_shuffle(spark):
    plan = queries.op5_quality_rules(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_simhash(spark, edges, empty, documents):
    for got, rows in ((simhash.near_duplicates(edges), EDGES),
                      (queries.op6_simhash(spark, FOLDER), [d[:2] for d in documents])):
        assert sorted_rows(got, "doc_id", "fingerprint", "component_id") == \
            brute.simhash_components(rows)
    assert simhash.near_duplicates(empty).count() == 0


def test_long_lists_lose_no_link(spark, monkeypatch):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(400):
        p = rng.choice(sorted(prints))
        for b in rng.sample(range(64), rng.choice((1, 2, 3))):
            p ^= 1 << b
        prints.add(p)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "fp long")

    def groups(links):
        from surtido.llm.common import components
        found = dict(tuple(r) for r in components(links).collect())
        return Counter(Counter(found.get(p, p) for (p,) in signed).values())

    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    want = Counter(Counter(map(root, prints)).values())
    assert groups(simhash.links(df)) == want
    monkeypatch.setattr(simhash, "LIST_MOST", 3)
    links = simhash.links(df)
    assert groups(links) == want
    assert links.where("bit_count(a ^ b) > 2").count() == 0


def test_long_lists_lose_no_link_of_one_bit(spark, monkeypatch):
    prints = spark.createDataFrame([(2,), (5,), (6,), (7,), (256,)], "fp long")
    want = {(2, 6), (5, 7), (6, 7)}
    for most in (64, 2):
        monkeypatch.setattr(simhash, "LIST_MOST", most)
        found = simhash.links(prints, 1).collect()
        assert {tuple(sorted((r["a"], r["b"]))) for r in found} == want
        assert simhash.links(prints, 0).count() == 0


def test_line_dedup(spark, edges, empty, documents):
    def digests(docs):
        out = lines.drop_lines(docs, lines.keep_bitmaps(docs))
        return out.select("row.doc_id", "n_lines", "n_dropped",
                          F.sha2(F.col("text").cast("binary"), 256).alias("sha"))

    assert sorted_rows(digests(edges), "*") == brute.line_dedup(EDGES)
    assert sorted_rows(queries.op8_line_dedup(spark, FOLDER), "*") == brute.line_dedup(
        [d[:2] for d in documents])
    assert digests(empty).count() == 0


def test_a_line_over_several_partitions(spark):
    docs = [(i, f"the same long line\nown line number {i % 7}") for i in range(60, 0, -1)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lines.drop_lines(df, lines.keep_bitmaps(df))
        got = sorted_rows(out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(
            F.col("text").cast("binary"), 256)), "*")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute.line_dedup(docs)


def test_bitmaps_round_trip():
    for dropped, n in (([0], 1), ([7], 8), ([8], 20), ([1, 2, 30], 31)):
        keep = lines.unpack(lines.pack(dropped), n)
        assert sorted(set(range(n)) - set(np.flatnonzero(keep))) == dropped


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(queries.RANKS))


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=dict(ranks), special_tokens={})


def test_split_equals_tiktoken(encoding, ranks):
    find = bpe.split_pattern(public_tokenizers.PATTERN).findall
    rng = random.Random(2)
    signs = "aZé'ſsßll\x1c\x1d\x1f\x85\xa0 ​  \t\n\r0٣Ⅷ½漢ñ́\U0001F600.,'"
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        ids = [i for w in find(text) for i in bpe.merge_bytes(w.encode(), ranks)]
        assert ids == encoding.encode_ordinary(text), repr(text)


def test_fold_equals_tiktoken(spark, encoding, ranks, documents):
    find = bpe.split_pattern(public_tokenizers.PATTERN).findall
    words = sorted({w for _, t, *_ in [*documents, *EDGES] for w in find(t or "")
                    if len(w) < 200})[:6000]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: list(r["ids"]) for r in bpe.encode_words(df, ranks).collect()}
    assert got == {w: encoding.encode_ordinary(w) for w in words}


def test_encode_and_decode(spark, edges, empty, encoding, ranks, documents):
    coded = bpe.encode(edges, ranks, public_tokenizers.PATTERN, frequent=20)
    back = bpe.decode(coded.drop("decoded"), ranks).select("row.doc_id", "ids", "decoded")
    assert sorted(((r[0], list(r[1]), bytes(r[2])) for r in back.collect()), key=str) == sorted(
        ((i, encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in EDGES), key=str)
    assert sorted_rows(coded.select("row.doc_id", "ids", "decoded"), "*") == sorted_rows(back, "*")
    assert bpe.encode(empty, ranks, public_tokenizers.PATTERN).count() == 0
    want = []
    for i, text, _ in documents:
        ids = encoding.encode_ordinary(text or "")
        want.append((i, len(ids), brute.sha(",".join(map(str, ids)).encode()),
                     brute.sha((text or "").encode())))
    assert sorted_rows(queries.op2_bpe(spark, FOLDER), "*") == sorted(want, key=str)


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    rows = found.where("held_out").select("lang", "lang_pred", "score").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


def test_language_edges(spark, edges, empty):
    model = langid.learn(edges)
    assert model.languages == ("en",)
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(edges, model).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (5, "und"), (1, "en"), (14, "en")} <= got
    assert langid.predict(empty, model).count() == 0
    nothing = langid.learn(empty)
    assert {r["lang_pred"] for r in langid.predict(edges, nothing).collect()} == {"und"}


def test_all_of_many_languages_are_learned(spark):
    def text(lang, n):
        letters = [chr(0x4E00 + 12 * lang + k) for k in range(12)]
        return " ".join("".join(letters[(n + 5 * w + k * (w + 1)) % 12] for k in range(6))
                        for w in range(30))

    rows = [(1000 * lang + n, text(lang, n), f"l{lang}") for lang in range(130)
            for n in range(2 + (lang < 70))]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 130 and model.slots.shape == (1 << langid.SLOT_BITS, 3)
    new = spark.createDataFrame([(lang, text(lang, 7)) for lang in range(130)],
                                "doc_id long, text string")
    got = langid.predict(new, model).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in got} == {(i, f"l{i}") for i in range(130)}
    assert all(r["score"] > 0.9 for r in got)


def test_false_hits_are_taken_off():
    model = langid.Model(("a", "b"), np.full(1 << langid.SLOT_BITS, np.uint64(1)),
                         np.array([1 - 1e-9, 0.0]))
    names, scores = langid._decide(["some text"], *(model.languages, model.slots, model.chance))
    assert names == ["a"] and 0 <= scores[0] <= 1


@pytest.fixture(scope="module")
def page_rows():
    big = "<p>" + "x" * 200 + "</p>"
    return [(5, "http://a", big), (3, "http://b\r\nX: y", big), (4, None, big), (9, "u", "short"),
            (8, "u", "short"), (7, "u", None), (6, "u", ""), (3, "http://c", big), (None, "u", big),
            (None, "v", "only here " * 20), (2, "u", "a\r\n\r\nWARC/1.1\r\nb" * 20), (1, "u", "é" * 49),
            (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "end\r\n\r\n"), (13, "u", "\n" * 120)]


def test_warc(spark, tmp_path, page_rows):
    pages = spark.createDataFrame([(*r, "x") for r in page_rows],
                                  "page_id long, url string, html string, digest string")
    got = warc.archive_pages(pages.repartition(3), str(tmp_path / "a"))
    assert sorted_rows(got, "*") == brute.warc([(i, h) for i, _, h in page_rows])
    assert warc.archive_pages(pages.limit(0), str(tmp_path / "b")).count() == 0


def test_warc_records_hold_payloads_once(spark, tmp_path, page_rows):
    pages = spark.createDataFrame(page_rows, "page_id long, url string, html string")
    warc.write(warc.payloads(pages), str(tmp_path / "a"), "an-archive")
    records = warc.read(spark, str(tmp_path / "a"), "an-archive").collect()
    for r in records:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    stored = sorted(bytes(r["payload"]).decode() for r in records if r["payload"] is not None)
    want = [h or "" for (i, _, h), w in zip(page_rows, map(
        lambda p: p, page_rows)) if (i, len((h or "").encode())) and not any(
            x[0] == i and x[3] == "revisit" and x[2] == brute.sha((h or "").encode())
            for x in brute.warc([(a, c) for a, _, c in page_rows]))]
    assert stored == sorted(want)
    text = "".join(r["value"] for r in spark.read.text(str(tmp_path / "a"), wholetext=True).collect())
    assert text.count("WARC-Type: revisit\r\n") == sum(r["record_type"] == "revisit" for r in records)


def test_warc_on_all_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()
    assert sorted_rows(queries.op4_warc_revisits(spark, FOLDER), "*") == brute.warc(
        [tuple(r) for r in pages])


def test_sharding(spark, edges, empty, documents):
    tree = sharding.balanced_tree(8)
    for got, rows in ((sharding.shard_documents(edges, tree), EDGES),
                      (queries.op9_sharding(spark, FOLDER), [d[:2] for d in documents])):
        found = got.collect()
        assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=str) == sorted(
            ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows),
            key=str)
        shards, ids = defaultdict(list), defaultdict(set)
        for r in found:
            shards[r["shard"]].append(r["slot"])
            ids[r["doc_id"]].add((r["shard"], r["grown_shard"]))
            assert r["grown_shard"] in (r["shard"], 8)
        assert all(sorted(s) == list(range(len(s))) for s in shards.values())
        assert all(len(s) == 1 for s in ids.values()) and set(shards) <= set(range(8))
    assert sharding.shard_documents(empty, tree).count() == 0


def test_weights_and_confined_movement(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "k")
    tree = {(0, 0, 0): 1.0, (0, 0, 1): 3.0, (0, 1, 2): 2.0, (1, 0, 3): 2.0, (1, 0, 4): 0.0}
    heavier = {**tree, (1, 0, 3): 4.0}
    out = sharding.assign(sharding.assign(rows, F.col("k"), tree, "a"), F.col("k"), heavier, "b")
    share = {r["a"]: r["n"] / 40_000 for r in out.groupBy("a").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert set(share) == {0, 1, 2, 3}
    for shard, part in {0: 1 / 8, 1: 3 / 8, 2: 2 / 8, 3: 2 / 8}.items():
        assert abs(share[shard] - part) < 0.01
    assert out.where("a <> b AND b <> 3").count() == 0


def test_sharding_plan_is_native(spark):
    plan = queries.op9_sharding(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["op4_warc_revisits", "op5_quality_rules", "op8_line_dedup"])
def test_query_equals_its_twin(spark, name):
    from tests.compare import compare, connect
    assert compare(spark, connect(FOLDER), FOLDER, name)[0].startswith("ok")
