"""Values that the queries owe on awkward rows, models against plain versions, the pipeline stage by stage."""

import hashlib
import re
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LABELS, WORDS, awkward, plain_components, shingle_set
from tidewheel.llm import common, language, mixing, quality, queries, secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark)


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    root = tmp_path_factory.mktemp("awkward")
    docs.write.parquet(f"{root}/documents.parquet")
    labels = [(9, 0, 1), (0, 1, 0), (1, 1, 0), (99, 1, 1), (None, 1, 0), (2, None, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{root}/labels.parquet")
    return str(root)


def result(spark, folder, name):
    return queries.QUERIES[name](spark, folder).collect()


def test_scores_of_awkward_documents(spark, folder):
    for name in ("op1_quality", "op2_toxicity"):
        rows = result(spark, folder, name)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        by_id = {}
        for r in rows:
            by_id.setdefault(r["doc_id"], set()).add(r["score"])
        assert all(len(scores) == 1 for i, scores in by_id.items() if i is not None)  # repeated rows
        held = {r["doc_id"] for r in rows if r["held_out"]}
        import zlib

        assert held == {i for i in by_id if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    scores = {r["doc_id"]: r["score"] for r in result(spark, folder, "op2_toxicity")}
    assert scores[3] == scores[4] == scores[5]  # null, empty, white space


def test_near_duplicates_of_awkward_documents(spark, docs, folder):
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    sets = {i: shingle_set(t, 3) for i, t in texts.items()}
    want = plain_components(
        list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and bool(sets[a])
    )
    rows = result(spark, folder, "op5_near_dedup")
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in rows if r["doc_id"] is not None)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)


def test_languages_of_awkward_documents(spark, docs, folder):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in result(spark, folder, "op7_language"):
        known = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        if r["doc_id"] is not None:
            assert (r["lang_pred"] in ("en", "fr")) if known else (r["lang_pred"] == "und" and r["score"] == 0)
    marks = spark.createDataFrame([(i, t) for i, t in enumerate(["½", "²", "Ⅷ", "①", "12", "a", "ß"])], "doc_id long, text string")
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet").limit(200))
    found = {r["text"]: r["lang_pred"] == "und" for r in language.predict(marks, model).collect()}
    assert found == {"½": True, "²": True, "Ⅷ": True, "①": True, "12": True, "a": False, "ß": False}


def test_training_and_scoring_count_the_same_grams():
    for text in ("", "a", "hello", "é b"):
        buckets, _ = language.subwords([text])
        found, counts = np.unique(buckets, return_counts=True)
        table = np.zeros((language.BUCKETS, 1), np.float32)
        table[:, 0] = np.arange(language.BUCKETS) % 97
        mean = (counts / counts.sum()) @ table[found, 0]
        assert language.text_logits([text, "other"], table)[0, 0] == pytest.approx(mean, rel=1e-5)


def test_first_step_follows_the_gradient(monkeypatch):
    monkeypatch.setattr(language, "EPOCHS", 1)
    monkeypatch.setattr(language, "BATCH", 1)
    ids, shares = [np.array([3, 70, 900])], [np.array([0.5, 0.25, 0.25], np.float32)]
    start = np.random.default_rng(7).normal(0, 0.1, (language.BUCKETS, language.DIM)).astype(np.float32)
    embed, linear = language.train(ids, shares, np.array([2]), 3)
    mean = (shares[0] @ start[ids[0]]).astype(float)
    loss = lambda w: -np.log(language.softmax((mean @ w)[None])[0, 2])
    slope, h = np.zeros((language.DIM, 3)), 1e-5
    for i in np.ndindex(*slope.shape):
        moved = np.zeros_like(slope)
        moved[i] = h
        slope[i] = (loss(moved) - loss(-moved)) / (2 * h)
    assert linear == pytest.approx(-language.RATE * slope, abs=1e-5)
    assert (embed == start).all()  # the map was still zero


ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def contract_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets_follow_the_contract_on_every_row(spark, tmp_path):
    hard = [
        "apikey:abcdef", "API_KEY = 'x.y/z+w='", "api__key=abcdef", "passwd\"  :  \"123456", "token=short", "tokentoken=abcdefg",
        "secret= token=abcdef", "passwordpassword:abcdef", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "xAKIA" + "1" * 20 + "_", "0" * 24, "0" * 23,
        "é" * 5 + "deadbeef" * 3 + "g" + "0123456789abcdef" * 2, "Token\t=abcdefg", "secret:\nabcdefgh", "password==abcdef", "",
    ]
    rows = [(i, text, "s") for i, text in enumerate(hard)] + [(900, None, None)]
    sample = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "source")
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(sample)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    got = queries.QUERIES["op3_secrets"](spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = contract_spans(texts[r["doc_id"]])
        counts = Counter(k for _, k, _ in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (counts[0], counts[1], counts[2]), texts[r["doc_id"]]
        label = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(label.encode()).hexdigest()
        assert set(label.split(",")) - {""} <= set(r["spans"].split(","))


def test_co_training_matches_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(quality, "ROUNDS", 2)
    sample = spark.read.parquet(f"{SF}/documents.parquet").limit(400).persist()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.fit(sample, labels, pseudo_rows=10**6, rounds=2, sure_share=0.2)

    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = sorted((r["doc_id"], r["text"], r["source"], r["lang"]) for r in sample.collect())
    import zlib

    seen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]

    def plain(some, label):
        ids, shares, layout = [], [], []
        for _, text, source, lang in some:
            found, counts = np.unique(language.subwords([text])[0], return_counts=True)
            ids.append(found.astype(np.int32))
            shares.append((counts / counts.sum()).astype(np.float32))
            layout.append(quality.layout_of(text, source, lang))
        return quality.Rows(ids, shares, np.array(layout), np.array(label, int))

    known = [r for r in seen if r[0] in marks]
    other = [r for r in seen if r[0] not in marks]

    def exchange(views, good):
        out = []
        scores = views.of_texts([r[1] for r in other], [(r[2], r[3]) for r in other])
        for score in scores:
            order = np.sort(np.floor(score * quality.BINS_PER_LOGIT))
            low = high = None
            for edge in np.unique(order):
                if (order <= edge).sum() <= 0.2 * (1 - good) * len(order):
                    low = min(0.0, (edge + 1) / quality.BINS_PER_LOGIT)
                if high is None and (order >= edge).sum() <= 0.2 * good * len(order):
                    high = max(0.0, edge / quality.BINS_PER_LOGIT)
            label = [1 if high is not None and s >= high else 0 if low is not None and s < low else -1 for s in score]
            sure = [i for i, x in enumerate(label) if x >= 0]
            out.append(plain([other[i] for i in sure], [label[i] for i in sure]))
        return tuple(out)

    want = quality.co_train(plain(known, [marks[r[0]] for r in known]), exchange, 2)
    assert got.both == pytest.approx(want.both, rel=1e-3)
    assert got.layout == pytest.approx(want.layout, rel=1e-3, abs=1e-6)
    assert got.table == pytest.approx(want.table, rel=1e-3, abs=1e-5)


def test_the_pipeline_stage_by_stage(spark, docs, folder):
    import corpus_pipeline as pipeline

    key = lambda r: tuple(map(str, r))
    rows = docs.collect()

    clean = pipeline.drop_toxic(spark, docs, folder)  # these labels teach no term
    assert sorted(map(key, clean.collect())) == sorted(map(key, rows))

    one = pipeline.drop_near_copies(spark, docs, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    sets = {i: shingle_set(t, 5) for i, t in texts.items()}
    group = plain_components(
        list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and bool(sets[a])
    )
    kept = sorted(i for i in sets if group[i] == i)
    assert sorted(r["doc_id"] for r in one if r["doc_id"] is not None) == kept
    assert sum(r["doc_id"] is None for r in one) == 2

    safe = pipeline.redact_secrets(spark, docs, folder).collect()
    assert len(safe) == len(rows)
    for r in safe:
        before = texts.get(r["doc_id"])
        if r["doc_id"] is not None:
            spans = contract_spans(before or "")
            assert bool(spans) <= (r["text"] != before)
            assert not any(before[a:b] in (r["text"] or "") for a, _, b in spans)
            assert spans or "[" in (r["text"] or "") or r["text"] == before

    mixed = Counter(map(key, pipeline.mix_sources(spark, docs, folder).collect()))
    numbered = common.staged(docs.withColumn("n", F.monotonically_increasing_id()), "test")
    taken = {r["row"]: r for r in mixing.mix(numbered, row_col="n").collect()}
    want = Counter()
    for r in numbered.collect():
        mix = taken[r["n"]]
        assert mix["size"] == len(WORDS.findall(r["text"] or ""))
        times = int(mix["taken"] / mix["size"] + 0.5) if mix["size"] else 0
        want[key(tuple(r)[:-1])] += times
    assert mixed == +want

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = pipeline.encode_text(spark, docs, folder).collect()
    assert sorted(key(tuple(r)[: len(docs.columns)]) for r in coded) == sorted(map(key, rows))
    for r in coded:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(array("I", r["token_ids"])) == ids and r["n_tokens"] == len(ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_rows_without_an_id_and_repeated_ids_are_mixed_on_their_own(spark, folder):
    import corpus_pipeline as pipeline

    rows = [(None, "four words are here", "a"), (7, "six words are in this text", "a"), (7, "seven", "a"), (8, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = Counter(r["text"] for r in pipeline.mix_sources(spark, df, folder).collect())
    # the only source is taken one and a half times: each text once at least
    assert set(out) == {r[1] for r in rows if r[1]} and all(n in (1, 2) for n in out.values())


def test_staged_tables_are_removed(spark, tmp_path, monkeypatch):
    from tidewheel.llm import graph

    names = iter(range(1000))
    monkeypatch.setattr(common, "shared_dir", lambda spark, purpose: f"{tmp_path}/{purpose}-{next(names)}")
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")
    with common.workspace() as keep:
        found = keep(common.staged(graph.components(edges), "found"))
    assert found.where("component = 0").count() == 21
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["found"]
    common.release(found)
    assert not list(tmp_path.iterdir())
