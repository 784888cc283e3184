"""Each operator against a plain version, the library it follows, or held-out labels."""

from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, LABELS, WORDS, awkward, empty, plain_components, plain_removed, shingle_set
from tidewheel.llm import (
    embedding_dedup,
    graph,
    language,
    lexicon,
    mixing,
    near_dedup,
    quality,
    queries,
    secrets,
    substrings,
    tokens,
    topk,
    toxicity,
)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark)


def folder_of(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def some_labels(spark):
    return spark.createDataFrame([(9, 0, 1), (0, 1, 0), (1, 1, 0), (99, 1, 1), (None, 1, 0), (2, None, None)], LABELS)


@pytest.fixture(scope="module")
def clashing(docs):
    """The awkward table with columns named like outputs and inner columns of the operators."""
    names = "toxic_score quality_score lang_pred LANG_SCORE lang_rejected token_ids decoded n_tokens _row _base _spans _number number copy row".split()
    return docs.selectExpr("*", *(f"concat('mine ', doc_id) as `{name}`" for name in names))


def test_outputs_replace_columns_of_their_name(spark, clashing):
    labels = some_labels(spark)
    results = {
        "toxic_score": toxicity.score(clashing, toxicity.fit(clashing, labels)),
        "quality_score": quality.score(clashing, quality.fit(clashing, labels)),
        "lang_score": language.predict(clashing, language.fit(clashing)),
        "decoded": tokens.encode(clashing, queries.vocabulary()),
    }
    for name, out in results.items():
        rows = out.collect()
        assert len(rows) == clashing.count()
        lowered = [column.lower() for column in out.columns]
        assert lowered.count(name) == 1 and len(lowered) == len(set(lowered))
        assert {row["_row"] for row in rows} == {row["_row"] for row in clashing.collect()}
    assert dict(results["toxic_score"].dtypes)["toxic_score"] == "double"
    found, rest = secrets.scan(clashing)
    assert sorted(found.columns) == sorted(clashing.columns) and rest.columns == clashing.columns
    assert found.select("_row").union(rest.select("_row")).subtract(clashing.select("_row")).count() == 0


def test_stages_keep_columns_of_any_name(spark, clashing, tmp_path):
    import corpus_pipeline

    folder = folder_of(tmp_path, labels=some_labels(spark))
    mine = {tuple(row) for row in clashing.select("toxic_score", "_spans", "_row", "_number", "decoded").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing, folder)
        assert {tuple(row) for row in out.select("toxic_score", "_spans", "_row", "_number", "decoded").collect()} <= mine, name
        assert len(out.columns) == len(set(map(str.lower, out.columns))), name


DOCUMENT_QUERIES = [name for name in queries.QUERIES if int(name[2:].split("_")[0]) not in (9, 10)]


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_awkward_and_empty_documents(spark, docs, tmp_path, name):
    folder = folder_of(tmp_path / "full", documents=docs, labels=some_labels(spark))
    rows = queries.QUERIES[name](spark, folder).collect()
    assert len(rows) == docs.count()
    folder = folder_of(tmp_path / "none", documents=empty(spark), labels=empty(spark, LABELS))
    assert queries.QUERIES[name](spark, folder).count() == 0


@pytest.mark.parametrize("name", ["op9_topk", "op10_embedding_dedup"])
def test_awkward_and_empty_vectors(spark, tmp_path, name):
    kind = "vec_id long, embedding array<float>, label int, score string, rank int"
    nan, inf = float("nan"), float("inf")
    vectors = [
        [1.0, 0.0], [1.0, 0.0], [0.0, 0.0], None, [], [nan, 1.0], [inf, 1.0], [None, 1.0], [-1.0, 0.001], [2.0, 0.01], [1.0]
    ]
    rows = [(i, v, None, "x", 1) for i, v in enumerate(vectors)] + [(0, [1.0, 0.0], 1, "y", 2), (None, [1.0, 0.0], 1, "z", 3)]
    folder = folder_of(tmp_path / "full", embeddings=spark.createDataFrame(rows, kind))
    found = queries.QUERIES[name](spark, folder).collect()
    if name == "op10_embedding_dedup":
        assert len(found) == len(rows)
        by_id = {row["vec_id"]: row for row in found if row["vec_id"] is not None}
        assert by_id[9]["component_id"] == 0 and by_id[1]["n_links"] == 4
        assert all(by_id[i]["n_links"] == 0 and by_id[i]["kept"] for i in (2, 3, 4, 5, 6, 7, 8))
    else:
        assert [(row["vec_id"], row["score"]) for row in found][:3] == [(9, 128 * 64), (1, 4096), (10, 4096)]
    folder = folder_of(tmp_path / "none", embeddings=spark.createDataFrame([], kind))
    assert queries.QUERIES[name](spark, folder).count() == 0


def test_stages_on_awkward_documents(spark, docs, tmp_path):
    import corpus_pipeline

    folder = folder_of(tmp_path, labels=some_labels(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert out.count() > 0
        assert stage(spark, empty(spark), folder).count() == 0, name
    assert stage(spark, docs, folder).count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.columns[: len(docs.columns)] == docs.columns and last.count() == docs.count()


def test_secret_spans_match_plain_search(spark, docs):
    import re

    assign = re.compile(secrets.ASSIGN.replace("(?=[PpSsTtAa])", ""))
    found, rest = secrets.scan(docs)
    assert found.count() + rest.count() == docs.count()
    for row in found.select("text", secrets.label(secrets.base_only(F.col("_spans"))).alias("spans")).collect():
        text = row["text"]
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert row["spans"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(want))


def test_secret_ownership_and_redaction(spark):
    value = "Zx81kQ0pLm47Tt5vYw29Bc63Nd08Hs1jKq"
    rows = [(i, f"see {value}{'' if i < 4 else 'other9'} here", f"s{i}") for i in range(5)]
    found, _ = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    out = {r["doc_id"]: r for r in found.select("doc_id", "_spans", secrets.redact(F.col("text"), F.col("_spans")).alias("t")).collect()}
    assert not out[0]["_spans"] and out[0]["t"] == rows[0][1]  # four owners: an example
    assert out[4]["t"] == "see [secret] here"


def test_substrings_match_plain_removal(spark, docs, monkeypatch):
    for hot in (substrings.HOT, 1):
        monkeypatch.setattr(substrings, "HOT", hot)
        some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
        rows = some.orderBy("doc_id").collect()
        want = plain_removed([(row["text"] or "").encode() for row in rows])
        got = {row["doc_id"]: bytes(row["kept"]) for row in substrings.remove_repeats(some).collect()}
        assert [got[row["doc_id"]] for row in rows] == want


def test_buckets_end_where_leading_bytes_change(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    leads = sorted(bytes([x]) * 16 for x in rng.integers(0, 12, 300))
    rows = pa.table({"lead": pa.array(leads, pa.binary()), "bytes": pa.array([b"x" * int(n) for n in rng.integers(1, 9, 300)], pa.binary())})
    for least in (1, 20, 100, 10_000):
        monkeypatch.setattr(substrings, "BUCKET", least)
        for width in (1, 7, 50, 300):
            found = list(substrings._buckets(rows.to_batches(max_chunksize=width)))
            assert pa.concat_tables(found).equals(rows)
            firsts = [(t["lead"][0].as_py(), t["lead"][-1].as_py()) for t in found]
            assert all(a[1] != b[0] for a, b in zip(firsts, firsts[1:]))
            sizes = [sum(map(len, t["bytes"].to_pylist())) for t in found]
            assert all(n >= least for n in sizes[:-1]) and len(found) == (1 if least == 10_000 else len(found))


def test_substrings_of_repeated_ids(spark):
    rng = np.random.default_rng(4)
    one, two, three = ("".join(chr(97 + i) for i in rng.integers(0, 26, 400)) for _ in range(3))
    rows = [(1, one + two), (1, two + one + one), (1, one + two), (2, three + two), (2, "short"), (None, three)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], bytes(r["kept"]).decode()) for r in substrings.remove_repeats(df).collect())
    # rows of one id are no copies of each other; within a row, and below a greater id, repeats go
    want = [(0, 400, three), (1, 800, one + two), (1, 800, one + two), (1, 1200, two + one), (2, 5, "short"), (2, 800, "")]
    assert got == sorted(want)


def test_near_duplicates_match_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        words = [f"w{i}" for i in rng.integers(0, 500, rng.integers(3, 90))]
        for _ in range(rng.integers(1, 9)):
            copy = list(words)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(len(copy))] = "changed"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingle_set(t, 3) for i, t in enumerate(texts)}
    want = plain_components(
        list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and bool(sets[a])
    )
    for block, most in ((near_dedup.BLOCK, near_dedup.SHINGLES), (2, near_dedup.SHINGLES), (100, 120)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "SHINGLES", most)
        got = {r["doc_id"]: r for r in near_dedup.near_duplicates(df, 3, 85).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(got[i]["n_shingles"] == len(sets[i]) for i in sets)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(300, 300)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[200 + i] == 100 for i in range(50)) and 300 not in got


def test_mix_reaches_targets(spark, docs):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == round(own[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["size"] == len(WORDS.findall(texts[r["doc_id"]] or "")) for r in rows if r["doc_id"] is not None)


def test_tokens_match_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for df, size in ((docs.select("doc_id", "text"), 5), (documents, 2_000)):
        for row in tokens.encode(df, path, size).collect():
            ids = reference.encode(row["text"] or "", add_special_tokens=False).ids
            assert list(array("I", row["token_ids"])) == ids
            assert row["decoded"] == reference.decode(ids, skip_special_tokens=False)


def test_merges_in_step_match_merges_on_a_heap():
    import random

    from tokenizers import Tokenizer

    path = queries.vocabulary()
    reference, tokenizer = Tokenizer.from_file(path), tokens.Tokenizer(path)
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinrstxé") for _ in range(rng.randint(1, 30))) for _ in range(800)]
    words = list(dict.fromkeys([*words, "a" * 300, "an" * 90, "x", "aaa", "aaaa", "b" * 1000]))
    assert tokenizer.ordered
    ids = tokenizer.ids_of(words)
    ends = ids.sizes.cumsum().tolist()
    for word, end, size in zip(words, ends, ids.sizes.tolist(), strict=True):
        own = ids.flat[end - size : end].tolist()
        assert own == tokenizer.merge_one(word.encode()) == reference.encode(word, add_special_tokens=False).ids


def test_lexicon_words_are_the_most_frequent(spark):
    rows = [(f"w{i}", n) for i, n in enumerate([1, 2, 2, 3, 9, 5000, 6000, 4097])]
    counts = spark.createDataFrame(rows, "word string, n long")
    assert sorted(tokens.frequent_words(counts, 5)) == ["w3", "w4", "w5", "w6", "w7"]
    assert sorted(tokens.frequent_words(counts, 100)) == [f"w{i}" for i in range(1, 8)]
    assert tokens.frequent_words(counts, 0) == []


def test_lexicon_shares_endings(tmp_path):
    entries = {w: [i, 7, i] for i, w in enumerate(["", "a", "walking", "talking", "walked", "talked", "é", "ée"])}
    (tmp_path / "x").write_bytes(lexicon.build(entries))
    found = lexicon.Transducer(str(tmp_path / "x"))
    assert all(found.find(w) == ids for w, ids in entries.items())
    assert found.find("walk") is None and found.find("zzz") is None
    words = [*entries, "walk", "zzz", "walkings"]
    raw = [w.encode() for w in words]
    sizes = np.array(list(map(len, raw)))
    numbers = found.find_all(np.frombuffer(b"".join(raw), np.uint8), sizes.cumsum() - sizes, sizes)
    order = sorted(entries, key=str.encode)
    assert numbers.tolist() == [order.index(w) if w in entries else -1 for w in words]
    assert found.states < 16


def test_top_k_matches_all_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (300, 5)) / 8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = topk.search(df, every=20, k=7).collect()
    z = np.floor(64 * x).astype(int)
    for q in range(0, 300, 20):
        score = z @ z[q]
        want = sorted((i for i in range(300) if i != q), key=lambda i: (-score[i], i))[:7]
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [(r["vec_id"], r["score"]) for r in rows] == [(i, score[i]) for i in want]


def test_rings_are_skipped_on_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(16, 8)) * 4
    x = centres[np.arange(1600) % 16] + rng.normal(size=(1600, 8)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    asked = []
    real = topk.visit

    def visit(queries, placed, parts, *rest):
        asked.append((queries.agg(F.sum(F.size("places"))).first()[0], len(parts), queries.count()))
        return real(queries, placed, parts, *rest)

    monkeypatch.setattr(topk, "visit", visit)
    got = topk.search(df, every=50, k=5).collect()
    z = np.floor(64 * x.astype(np.float32).astype(float)).astype(int)
    for q in range(0, 1600, 50):
        score = z @ z[q]
        want = sorted((i for i in range(1600) if i != q), key=lambda i: (-score[i], i))[:5]
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [(r["vec_id"], r["score"]) for r in rows] == [(i, score[i]) for i in want]
    visits, rings = sum(n for n, _, _ in asked), asked[0][1]
    assert visits < 0.5 * rings * 32, asked


def test_top_k_at_the_edge_of_exact_scores(spark):
    rng = np.random.default_rng(5)
    # scores near 2^53: no room to pack an id beside them
    x = rng.integers(2**24, int(2**25.2), (600, 6)) / 64.0
    x[100] = x[200] = x[300]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = topk.search(df, every=100, k=5)
    z = np.floor(64 * x).astype(object)
    rows = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got.collect()}
    assert len(rows) == 30
    for q in range(0, 600, 100):
        score = [int(v @ z[q]) for v in z]
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:5]
        assert [rows[q, n + 1] for n in range(5)] == [(i, score[i]) for i in want]
    too_large = df.selectExpr("vec_id", "transform(embedding, v -> v * 64) as embedding")
    with pytest.raises(OverflowError):
        topk.search(too_large, every=100, k=5)


def test_top_k_of_repeated_query_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0])]
    both = [
        [tuple(r) for r in topk.search(spark.createDataFrame(x, "vec_id long, embedding array<double>"), 20, 2).collect()]
        for x in (rows, rows[::-1])
    ]
    assert both[0] == both[1] == [(0, 1, 2, 8192), (0, 2, 1, 0)]


def test_embedding_links_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "INTERVAL", 64)
    monkeypatch.setattr(embedding_dedup, "LEAF", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 12))
    x = (centres[rng.integers(0, 40, 400)] + rng.normal(size=(400, 12)) * 0.25).astype(np.float32).astype(float)
    x[7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    want = plain_components(list(range(400)), lambda a, b: close[a, b])
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_links"] == close[i].sum() - 1 for i, r in got.items())


def test_distant_vectors_are_skipped(spark, monkeypatch):
    """On vectors in clusters most pairs of intervals, and most of the work in them, go."""
    monkeypatch.setattr(embedding_dedup, "INTERVAL", 16)
    monkeypatch.setattr(embedding_dedup, "LEAF", 4)
    rng = np.random.default_rng(3)
    centres = np.eye(6)[rng.integers(0, 6, 1280)] * rng.choice([-1, 1], 1280)[:, None]
    x = centres + rng.normal(size=(1280, 6)) * 0.02
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    seen = []
    real = embedding_dedup.interval_pairs

    def interval_pairs(laid, lead, epsilon):
        pairs = real(laid, lead, epsilon)
        sent = embedding_dedup.near_blocks(laid, pairs, lead, epsilon).count()
        seen.append((pairs.count(), laid.select("interval").distinct().count(), sent))
        return pairs

    monkeypatch.setattr(embedding_dedup, "interval_pairs", interval_pairs)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    assert all(r["n_links"] == close[i].sum() - 1 for i, r in got.items())
    (pairs, intervals, sent), = seen
    assert intervals == 80 and pairs < 0.5 * intervals * (intervals + 1) / 2
    assert sent < 0.8 * 4 * (2 * pairs - intervals), "of four blocks an interval"


def test_toxic_terms_with_errors_and_in_quotes():
    words = toxicity.Lexicon({"pathetic": (5.0, False), "lowei": (4.0, True), "scum": (3.0, False)})
    assert words.find("pathetic") == ("pathetic", 5.0, 0)
    assert words.find("pathetc") == ("pathetic", 5.0, 1)
    assert words.find("loweiung") == ("lowei", 4.0, 0)
    assert words.find("bathetic") == ("pathetic", 5.0, 1)  # the first letter is one of many
    assert words.find("scam") is None and words.find("path") is None
    abuse, quote, none = toxicity.measured(["you are PATHETIC", 'the word "pathetic" is in a list', ""], words)
    assert abuse[0] > 0 and abuse[2] == 0
    assert quote[0] == 0 and quote[2] > 0
    assert not none.any()


def plain_edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lexicon_finds_what_edit_distance_finds():
    import random

    rng = random.Random(6)
    some = lambda low, high: "".join(rng.choice("abé") for _ in range(rng.randint(low, high)))
    terms = {some(1, 12): (round(rng.random(), 1), rng.random() < 0.4) for _ in range(25)}
    words = list({some(1, 14) for _ in range(400)} | {"a" * 5_000})
    found = toxicity.Lexicon(terms).find_all(words)
    for word in words:
        options = []
        for term, (weight, stem) in terms.items():
            fronts = [word[:n] for n in range(min(len(word), len(term) + 3) + 1)] if stem else [word]
            edits = min(plain_edits(term, front) if abs(len(term) - len(front)) < 3 else 9 for front in fronts)
            if edits <= toxicity.allowed_edits(len(term)):
                options.append((edits, -weight, term))
        want = min(options, default=None)
        assert found.get(word) == (want and (want[2], -want[1], want[0])), word


def test_terms_of_any_length_are_learned():
    long = "l" * 60
    docs = [["bad", "day"], ["bad", "sun", long], ["bad", long]]
    counts = {}
    for own in docs:
        for front in toxicity.fronts_of(" ".join(own)):
            counts[front] = counts.get(front, 0) + 100
    rows = [(term, 0 if term.startswith(("bad", "l")) else 250, n) for term, n in counts.items()]
    terms = toxicity.learn_terms(rows, 300, 300)
    assert "bad" in terms and not terms["bad"][1]
    assert any(term.startswith("lll") for term in terms) and "day" not in terms and "sun" not in terms


def labelled(spark, model_rows, mark, score):
    labels = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/labels.parquet")
    both = model_rows.join(labels, "doc_id").where("held_out").select(mark, score).collect()
    return sum((row[score] >= 0.5) == bool(row[mark]) for row in both) / len(both)


def test_held_out_accuracy(spark):
    folder = SF.replace("0.01", "0.1")
    assert labelled(spark, queries.QUERIES["op1_quality"](spark, folder), "quality", "score") > 0.93
    assert labelled(spark, queries.QUERIES["op2_toxicity"](spark, folder), "toxic", "score") > 0.97
    found = queries.QUERIES["op7_language"](spark, folder).where("held_out")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right = found.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_models_without_labels(spark, docs):
    none = empty(spark, LABELS)
    for labels in (none, some_labels(spark)):
        scores = toxicity.score(docs, toxicity.fit(docs, labels)).select("toxic_score").distinct().collect()
        assert len(scores) == 1 and scores[0][0] < 0.5
    assert quality.fit(docs, none) is None
    assert language.fit(empty(spark, DOCS)) is None
