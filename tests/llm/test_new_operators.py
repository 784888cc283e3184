"""Runs, cleaning and alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import DOCS, WORDS, awkward, empty
from tidewheel.llm import alignment, cleaning, queries, runs, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark)


@pytest.fixture(scope="module")
def clashing(spark, docs):
    """The awkward table with columns named like outputs of the operators."""
    return docs.selectExpr("*", "1 as runs", "'x' as Collapsed", "2.5 as kept", "'y' as n_a", "doc_id as block", "3 as row")


def plain_runs(words):
    """Every stretch tried with every period."""
    out = []
    for start in range(len(words)):
        for stop in range(start + 6, len(words) + 1):
            period = next(q for q in range(1, stop - start + 1) if all(words[i] == words[i + q] for i in range(start, stop - q)))
            if stop - start < 4 * period:
                continue
            if start and words[start - 1] == words[start - 1 + period]:
                continue
            if stop < len(words) and words[stop] == words[stop - period]:
                continue
            out.append((start, stop, period))
    return sorted(out, key=lambda x: (x[0], x[2]))


def some_sequences(trials):
    rng = random.Random(4)
    for _ in range(trials):
        block = []
        for _ in range(rng.randint(1, 6)):
            size, letters = rng.randint(0, 36), rng.randint(1, 3)
            words = [rng.randrange(letters) for _ in range(size)]
            if rng.random() < 0.6 and size > 4:
                period = rng.randint(1, 6)
                words = [words[i] if i < 2 else words[2 + (i - 2) % period] for i in range(size)]
            block.append(words)
        block.append(list(block[0]))
        yield block


def test_runs_match_plain_search():
    for block in some_sequences(150):
        found = runs.find_runs([np.array(words, np.int64) for words in block])
        for words, own in zip(block, found, strict=True):
            want = plain_runs(words)
            assert own == want
            assert runs.direct(np.array(words, np.int64)) == want


def test_runs_survive_hashes_that_lie(monkeypatch):
    rng = np.random.default_rng(3)
    block = [rng.integers(0, 2, 60) for _ in range(5)] + [np.zeros(50, np.int64)]
    want = [runs.direct(x) for x in block]
    monkeypatch.setattr(runs.Prefixes, "equal", lambda self, a, gap, length: np.ones(len(a), bool))
    got = runs.find_runs(block)
    assert got == want


def test_grammar_derives_the_text_and_repeats_no_pair():
    rng = np.random.default_rng(8)
    seq = np.concatenate([rng.integers(0, 4, 300), np.zeros(100, np.int64), np.tile([1, 2, 3], 50)])
    starts = np.array([0, 250, 400])
    grammar = runs.Grammar(seq, starts)

    def derive(symbol):
        if symbol < grammar.words:
            return [symbol]
        rule = symbol - grammar.words
        return derive(grammar.left[rule]) + derive(grammar.right[rule])

    assert [x for root in grammar.roots for x in derive(root)] == seq.tolist()
    for rule, place in enumerate(grammar.place):
        size = grammar.size[grammar.words + rule]
        assert derive(grammar.words + rule) == seq[place : place + size].tolist()
    assert len(set(zip(grammar.left.tolist(), grammar.right.tolist(), strict=True))) == len(grammar.left)


def test_constant_text_has_few_rules():
    grammar = runs.Grammar(np.zeros(100_000, np.int64), np.array([0]))
    assert len(grammar.left) < 60
    assert runs.find_runs([np.zeros(100_000, np.int64)]) == [[(0, 100_000, 1)]]


def test_runs_query_matches_plain_version(spark, docs, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "substring(text, 1, 500) as text").collect()
    table = [(row["doc_id"], row["text"]) for row in rows] + [(r["doc_id"], r["text"]) for r in docs.collect()][3:8]
    long_text = " ".join(["a b"] * 5000)
    table += [(7_000_000 + i, f"x y {long_text}") for i in range(12)]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op11_runs"](spark, str(tmp_path)).collect()))
    want = []
    for doc_id, text in table:
        words = WORDS.findall(text or "")
        mark = zlib.crc32(str(doc_id).encode())
        group = mark // 10
        if mark % 10 == 0 and words:
            a = group % len(words)
            p = 1 + (len(words) - a) // (3 + group % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        coded = np.array([numbers[w] for w in words], np.int64)
        found = runs.direct(coded) if len(words) > 200 else plain_runs(words)
        keep = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in found)]
        best = min(found, key=lambda x: (x[0] - x[1], x[0], x[2])) if found else None
        first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (listed, " ".join(keep)))
        want.append((doc_id, len(found), *first, *digests))
    assert got == sorted(want)


def test_runs_on_awkward_rows(clashing, spark):
    rows = runs.periodic_runs(clashing).collect()
    assert rows[0].asDict().keys() == {*clashing.columns} - {"Collapsed"} | {"collapsed", "runs_sha256", "collapsed_sha256"}
    by_text = defaultdict(list)
    for row in rows:
        by_text[row["text"]].append((row["runs"], row["collapsed"]))
    assert by_text[None] == [([], "")] * 2
    assert by_text[""] == [([], "")] and by_text[" \n\t"] == [([], "")]
    assert len({str(x) for x in by_text[rows[0]["text"]]}) == 1  # repeated rows
    assert by_text["x" * 400_000] == [([], "x" * 400_000)]
    assert runs.periodic_runs(empty(spark)).count() == 0


def plain_cleaning(text):
    words = WORDS.findall(text or "")
    spots, where = set(), defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i : i + 5])].append(i)
    for found in where.values():
        if len(found) > 1:
            spots.update(j for i in found for j in range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(spots),
        "base_failed": len(words) < 10 or 100 * len(spots) > 20 * len(words),
    }


def test_cleaning_counts_match_plain_version(spark, clashing):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc\n") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    extra = spark.createDataFrame([(100 + i, t, None, None, 1, 0.5, "z") for i, t in enumerate(texts)], DOCS)
    rows = cleaning.clean_documents(clashing.drop("Collapsed", "runs", "n_a", "block", "row").unionByName(extra, True)).collect()
    assert len(rows) == clashing.count() + 200
    for row in rows:
        want = plain_cleaning(row["text"])
        assert {name: row[name] for name in want} == want
        assert not (row["kept"] and row["base_failed"])
    assert cleaning.clean_documents(empty(spark)).count() == 0


def test_line_rules():
    rules = cleaning.Rules()
    fault = lambda line, seen=False: cleaning.line_fault(line, len(line.split()), seen, rules)
    assert fault("Home | News | About | Contact") == "navigation"
    assert fault("a word |") == "punctuation"
    assert fault("We use a cookie here.") == "boilerplate"
    assert fault("Seen before.", True) == "boilerplate" and fault("Seen before.") is None
    assert fault("THIS IS SHOUTED AT EVERYONE!!") == "boilerplate"
    assert fault("one*** two$$$ three### four%%%.") == "boilerplate"
    assert fault("no end of a sentence") == "punctuation"
    assert fault('He said "yes."') is None and fault("One end. and then more words") is None


def test_cleaned_text_and_verdict(spark):
    prose = "\n".join(f"This{i} is{i} line{i} and{i} it{i} says{i} something new." for i in range(8))
    rows = [
        (1, prose + "\nHome | News | About\nShare this page."),
        (2, "One sentence that stays here.\n" + "\n".join("menu entry " + c for c in "abcdefgh")),
        (3, prose),
    ]
    got = {r["doc_id"]: r for r in cleaning.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["cleaned"] == prose and got[1]["kept"] and got[1]["n_navigation_lines"] == 1
    assert got[2]["cleaned"] == "One sentence that stays here." and not got[2]["kept"] and not got[2]["base_failed"]
    assert got[3]["kept"] and got[3]["n_kept_words"] == got[3]["n_words"]


def libraries():
    """Ids of a whole text by the libraries themselves, and the bytes of their tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    paths = [queries.vocabulary(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    one, two = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    one.encode_special_tokens = True
    letters = {letter: bytes([value]) for value, letter in enumerate(tokens.byte_letters())}
    names = {i: b"".join(letters.get(c, b"?") for c in name) for name, i in one.get_vocab().items()}
    pieces = {
        i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
        for i in range(two.get_piece_size())
    }
    return (lambda text: one.encode(" " + text, add_special_tokens=False).ids, names), (two.encode, pieces)


def plain_alignment(texts):
    """Groups by all common ends, links by all pairs of a text, counts by documents."""
    found, documents, both = [], Counter(), libraries()
    for text in texts:
        sides = [encode(text) if text else [] for encode, _ in both]
        want = b" " + (text or "").encode()
        if any(b"".join(names[i] for i in ids) != want for (_, names), ids in zip(both, sides, strict=True)):
            sides = [[], []]
        spans = []
        for (_, names), ids in zip(both, sides, strict=True):
            ends = np.cumsum([len(names[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=False)))
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = []
        for low, high in zip([0, *cuts[:-1]], cuts, strict=False):
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= high) for side in spans))
        pairs = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        documents.update(set(pairs))
        found.append((sides, groups, pairs))
    top = defaultdict(int)
    for (a, _), n in documents.items():
        top[a] = max(top[a], n)
    for (a, b), groups, pairs in found:
        yield {
            "n_a": len(a),
            "n_b": len(b),
            "n_groups": len(groups),
            "n_links": len(pairs),
            "groups": ";".join(groups),
            "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            "n_best": sum(documents[p] == top[p[0]] for p in pairs),
            "count_sum": sum(documents[p] for p in pairs),
        }


def test_alignment_matches_plain_version(spark, clashing):
    paths = [queries.vocabulary(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    texts = ["", " ", "a", "\n\n", "naïve 日本語 text​ ﬁ", "<s> <|endoftext|> <0x41> ▁", " lead", "trail ", "\x00", "é" * 50, "١٢٣"]
    texts += [r["text"][:700] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    extra = spark.createDataFrame([(100 + i, t, None, None, 1, 0.5, "z") for i, t in enumerate(texts)], DOCS)
    table = clashing.where("length(text) < 10000 or text is null").unionByName(extra, True).repartition(5)
    rows = alignment.align(table, *paths, keep_groups=True).join(table.select("doc_id", "text"), "doc_id").distinct()
    got = rows.collect()
    every = [r["text"] for r in table.collect()]
    want = dict(zip(every, plain_alignment(every), strict=True))
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in table.collect()} - {None}
    for row in got:
        assert {name: row[name] for name in want[row["text"]]} == want[row["text"]], row["text"]
    assert any(r["n_a"] == 0 and r["text"] for r in got) or all(r["n_a"] for r in got if r["text"])
    whole = alignment.align(table, *paths)
    assert whole.count() == table.count() and "text" not in whole.columns and "block" in whole.columns


def test_units_are_tokenized_like_whole_texts():
    paths = [queries.vocabulary(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    one, two = alignment.ByteTokenizer(paths[0]), alignment.PieceTokenizer(paths[1])
    assert two.ends_at_space
    rng = random.Random(11)
    parts = ["the", "and", "don't", "'s", "\n", "\t", " ", "  ", "\r\n", "\u00a0", "\u3000", "é", "日本", "12", "...", "!?", "x" * 30, "▁", "\x00"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    texts += ["".join(rng.choice([*parts, " "]) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    cut, both = 0, libraries()
    for text in texts:
        own = alignment.units(text, two)
        cut += len(own) > 1
        assert "".join(" " + x for x in own) == " " + text
        for tokenizer, (encode, _) in zip((one, two), both, strict=True):
            assert tokenizer.encode(own).flat.tolist() == tokenizer.encode([text]).flat.tolist() == encode(text), repr(text)
    assert cut > 50


def test_alignment_of_long_and_empty(spark):
    paths = [queries.vocabulary(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    assert alignment.align(empty(spark), *paths).count() == 0
    one, two = alignment.ByteTokenizer(paths[0]), alignment.PieceTokenizer(paths[1])
    texts = ["x" * 30_000, "日本" * 5_000]
    rows = alignment.align(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), *paths, keep_groups=True)
    a, b, good = alignment.tokenized(texts, one, two)
    assert good.all()
    for row in rows.collect():
        own = [x.counts[: row["doc_id"]].sum() for x in (a, b)]
        ends = [x.ends[o : o + x.counts[row["doc_id"]]] for x, o in zip((a, b), own, strict=True)]
        assert row["n_groups"] == len(set(ends[0].tolist()) & set(ends[1].tolist()))
        assert row["n_links"] == len(set(ends[0].tolist()) | set(ends[1].tolist()))
