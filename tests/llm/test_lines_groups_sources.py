"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import random
import re
import threading
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cuegrid.llm import alignment, common, line_dedup, source_audit
from cuegrid.llm.queries import BYTE_VOCABULARY, PIECE_MODEL

WHITE = " \t\n\v\f\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Operator 11


def deduped(texts, min_docs, min_chars=1, keep_first=False):
    """For each text its lines and whether each is dropped."""
    lines = [(t or "").split("\n") for t in texts]
    keys = [[lower(x.strip(WHITE)) for x in part] for part in lines]
    seen = Counter(k for part in keys for k in {k for k in part if len(k) >= min_chars})
    met, out = set(), []
    for part, own in zip(lines, keys, strict=True):
        drops = []
        for k in own:
            often = len(k) >= min_chars and seen[k] >= min_docs
            drops.append(often and not (keep_first and k not in met))
            if often:
                met.add(k)
        out.append((part, drops))
    return out


def some_lines(rng, docs):
    pool = ["Alpha", " alpha\t", "ALPHA", "b\x0b", "c c", "", "  ", "é", "É", "\xa0x", "long " * 50, "z"]
    texts = ["\n".join(rng.choices([*pool, f"own {i}", f"pair {i // 2}"], k=rng.randint(1, 9))) for i in range(docs)]
    return [*texts, None, "", "\n", "alpha\n" * 300, "z\r\nz"]


@pytest.mark.parametrize("seed,min_docs", [(1, 2), (2, 10), (3, 40)])
def test_line_digests(spark, seed, min_docs):
    texts = some_lines(random.Random(seed), 120)
    rows = [(i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("keep", F.lit(1))
    got = {r.doc_id: tuple(r)[1:] for r in line_dedup.line_dedup_digests(table.repartition(5), 1, min_docs).collect()}
    want = {}
    for i, (lines, drops) in enumerate(deduped(texts, min_docs)):
        kept = "\n".join(x for x, d in zip(lines, drops, strict=True) if not d)
        want[i] = (len(lines), sum(drops), hashlib.sha256(kept.encode()).hexdigest())
    assert got == want


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (2, 1), (3, 2)])
def test_first_occurrences_stay(spark, tmp_path, min_docs, min_chars):
    texts = some_lines(random.Random(7), 60)
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, keep string").coalesce(1).write.parquet(path)
    got = line_dedup.drop_repeated_lines(spark.read.parquet(path), min_chars, min_docs)
    assert got.columns == ["doc_id", "text", "keep"]
    want = deduped(texts, min_docs, min_chars, keep_first=True)
    assert {r.doc_id: r.text for r in got.collect()} == {
        i: "\n".join(x for x, d in zip(lines, drops, strict=True) if not d) for i, (lines, drops) in enumerate(want)
    }


def ranges(rows, cuts, min_docs, keep_first, batch, monkeypatch):
    """Rows (h1, h2, row, pos) streamed in ranges cut anywhere: what is dropped for sure, what is open, summaries."""
    out = []
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        monkeypatch.setattr(line_dedup.TaskContext, "get", staticmethod(lambda part=part: type("T", (), {"partitionId": lambda self: part})()))
        own = [pa.RecordBatch.from_pylist([dict(zip(["h1", "h2", "row", "pos"], r, strict=True)) for r in rows[i : min(b, i + batch)]]) for i in range(a, b, batch)]
        for x in line_dedup._stream(min_docs, keep_first)(iter(own)):
            out += x.to_pylist()
    return out


@pytest.mark.parametrize("keep_first", [False, True])
def test_runs_across_batches_and_ranges(monkeypatch, keep_first):
    rng = random.Random(11)
    for _ in range(150):
        min_docs = rng.randint(1, 4)
        rows = sorted({(0, rng.randint(0, 3), rng.randint(0, 5), rng.randint(0, 2)) for _ in range(rng.randint(1, 40))})
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(0, 4))))
        got = ranges(rows, cuts, min_docs, keep_first, rng.randint(1, 6), monkeypatch)
        edges = defaultdict(list)
        for r in got:
            if r["kind"] == "edge":
                edges[r["h2"]].append(r)
        dropped = {(r["h2"], r["row"], r["pos"]) for r in got if r["kind"] == "drop"}
        for r in (r for r in got if r["kind"] == "open"):
            parts = sorted(edges[r["h2"]], key=lambda e: e["part"])
            total = sum(e["n"] for e in parts) - sum(a["last"] == b["row"] for a, b in zip(parts, parts[1:], strict=False))
            first = (parts[0]["row"], parts[0]["pos"])
            if total >= min_docs and not (keep_first and first == (r["row"], r["pos"])):
                dropped.add((r["h2"], r["row"], r["pos"]))
        docs = defaultdict(set)
        for _, h, row, _p in rows:
            docs[h].add(row)
        firsts = {min((r for r in rows if r[1] == h))[1:] for h in docs}
        want = {r[1:] for r in rows if len(docs[r[1]]) >= min_docs and not (keep_first and r[1:] in firsts)}
        assert dropped == want
        assert len([r for r in got if r["kind"] == "edge"]) <= 2 * (len(cuts) + 1)


def test_lines_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert line_dedup.line_dedup_digests(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "same\nown"), (None, "same\nown"), (3, "same"), (3, "same"), *((i, "same") for i in range(10, 17))]
    got = line_dedup.line_dedup_digests(spark.createDataFrame(rows, schema), min_docs=10).collect()
    assert len(got) == len(rows) and all(r.n_dropped == 1 for r in got)
    assert Counter(r.doc_id for r in got)[None] == 2


def test_one_line_in_most_documents_and_a_very_long_text(spark):
    """Nine ranges of one key; a text of two million lines."""
    table = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Hot\nline "), "id").alias("text"))
    long = "\n".join(["hot"] * 1_000_000 + ["cold"] * 1_000_000)
    table = table.union(spark.createDataFrame([(-1, long)], "doc_id long, text string"))
    got = line_dedup.line_dedup_digests(table)
    assert got.agg(F.sum("n_dropped")).first()[0] == 3000 + 1_000_000
    row = got.where("doc_id = -1").first()
    assert row.n_lines == 2_000_000
    assert row.kept_sha256 == hashlib.sha256("\n".join(["cold"] * 1_000_000).encode()).hexdigest()


def test_bitmaps_are_compressed(spark):
    rows = spark.createDataFrame([(1, "a\n" * 80_000), (2, "a"), (3, None)], "row long, text string")
    got = {r.row: r for r in line_dedup.line_bitmaps(rows, "row", keep_first=False).collect()}
    assert got[1].n_lines == 80_001 and got[1].n_dropped == 80_000 and len(got[1].keep) < 100
    keep = np.unpackbits(np.frombuffer(zlib.decompress(got[1].keep), np.uint8), count=80_001)
    assert keep.sum() == 1 and keep[-1] == 1 and got[3].n_lines == 1 and got[3].n_dropped == 0


# Operator 12


def vocabularies():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def ends_of(parts):
    at, out = 0, []
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def plain_alignment(texts):
    """Whole texts tokenised at once; links by comparing byte ranges."""
    a, b = vocabularies()
    shown = {i: alignment.byte_level_bytes(t) for t, i in a.get_vocab().items() if i != 50256} | {50256: b"<|endoftext|>"}
    rows, pairs = [], Counter()
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xs = [shown[i] for i in x]
        ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or b"".join(xs) != (" " + text).encode() or b"".join(ys) != (" " + text).encode():
            rows.append(None)
            continue
        ex, ey = ends_of(xs), ends_of(ys)
        groups, i, j = [], 0, 0
        for end in sorted(set(ex) & set(ey)):
            m, n = ex.index(end) + 1, ey.index(end) + 1
            groups.append((x[i:m], y[j:n]))
            i, j = m, n
        links = []
        for k, q in enumerate(x):
            for m, r in enumerate(y):
                if max(ex[k] - len(xs[k]), ey[m] - len(ys[m])) < min(ex[k], ey[m]):
                    links.append((q, r))
        pairs.update(links)
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append((len(x), len(y), len(groups), links, hashlib.sha256(said.encode()).hexdigest()))
    most = defaultdict(int)
    for (_, q), n in pairs.items():
        most[q] = max(most[q], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n, m, g, links, digest = r
            out.append((n, m, g, len(links), sum(pairs[x] == most[x[1]] for x in links), sum(pairs[x] for x in links), digest))
    return out, pairs


ODD_TEXTS = [
    None, "", " ", "  ", "\n", " \n ", "a", "it's  two   spaces", "tab\t\tand nbsp  em", "x▁y", "▁", "<|endoftext|> </s><s>", "日本語のテキスト", "naïve café 😀👩‍🚀",
    "a\t\n b", "a \t b\r\n c", "\x00\x1f\x1c z", "trailing   ", "　wide", "12345 67,890.12", "ａｂｃ", "é", "line\n\n\nline", "\x85n", "''s 't 'LL", "퟿￿",
]


def test_alignment_equals_whole_texts(spark):
    rng = random.Random(5)
    marks = [" ", "  ", "\n", "\t", "a", "the", "Straße", "'s", ".", "9", "é", "日", " ", "\x1c", "ing", "un", "-", "😀", "\r\n", "ß", "#"]
    texts = [*ODD_TEXTS, *("".join(rng.choices(marks, k=rng.randint(1, 40))) for _ in range(200))]
    table = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").withColumn("row", F.lit(0))
    rows, pairs, dictionary = alignment.align_tokenizers(table.repartition(3), BYTE_VOCABULARY, PIECE_MODEL)
    want, counts = plain_alignment(texts)
    got = {r.doc_id: tuple(r)[1:] for r in rows.collect()}
    for i, w in enumerate(want):
        assert got[i] == w, repr(texts[i])
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts
    assert dictionary.count() == dictionary.select("key").distinct().count()


def test_chunks_end_where_both_vocabularies_end():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    a, b = vocabularies()
    aligner = alignment.Aligner(*alignment.read_vocabularies(BYTE_VOCABULARY, PIECE_MODEL))
    letters = st.sampled_from(" \n\t\r\x0b\x1c\x85  　aAzé1'.,-s日😀▁")

    @settings(max_examples=400, deadline=None)
    @given(st.text(letters | st.characters(exclude_categories=["Cs"]), min_size=1, max_size=30))
    def check(text):
        (made,) = aligner.align([text])
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if "▁" in text:
            assert made is None
            return
        assert made[:2] == (len(x), len(y))
        ids = [(alignment.ids_of(aligner.keys[n]), c) for n, c in zip(made[4].tolist(), made[5].tolist(), strict=True)]
        assert sum(len(p) * c for (p, _), c in ids) == len(x) and sum(len(q) * c for (_, q), c in ids) == len(y)

    check()


def test_alignment_of_odd_tables(spark, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, text string")
    rows, pairs, dictionary = alignment.align_tokenizers(empty, BYTE_VOCABULARY, PIECE_MODEL)
    assert rows.collect() == [] and pairs.collect() == [] and dictionary.collect() == []
    nothing = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in alignment.align_tokenizers(nothing, BYTE_VOCABULARY, PIECE_MODEL)[0].collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
    texts = ["same text", "same text", "x" * 300_000 + " end", "word " * 50_000]
    twice = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (2, texts[2]), (3, texts[3])], "doc_id long, text string")
    monkeypatch.setattr(alignment, "HOT", 0.3)  # most keys take the other way
    got = alignment.align_tokenizers(twice, BYTE_VOCABULARY, PIECE_MODEL)[0].collect()
    assert len(got) == 4 and len({tuple(r) for r in got if r.doc_id is None}) == 1
    assert next(r for r in got if r.doc_id == 3).n_groups == 50_001


def test_what_is_remembered_changes_nothing(monkeypatch):
    rng = random.Random(9)
    files = alignment.read_vocabularies(BYTE_VOCABULARY, PIECE_MODEL)
    words = ["x▁y", *("".join(rng.choices("abcdeéß日", k=rng.randint(1, 8))) for _ in range(300))]
    texts = [rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=20)) for _ in range(60)] + ["a x▁y"]
    show = lambda aligner, made: made and (*made[:4], Counter({aligner.keys[n]: c for n, c in zip(made[4].tolist(), made[5].tolist(), strict=True)}))
    plain = alignment.Aligner(*files)
    want = [show(plain, plain.align([t])[0]) for t in texts]
    for chunks, groups, chars in ((1, 500_000, 64), (50, 40, 64), (200_000, 500_000, 3)):
        for name, value in (("_MEMO_CHUNKS", chunks), ("_KNOWN_GROUPS", groups), ("_MEMO_CHARS", chars)):
            monkeypatch.setattr(alignment, name, value)
        aligner = alignment.Aligner(*files)
        got = []
        for i in range(0, 61, 7):
            got += [show(aligner, m) for m in aligner.align(texts[i : i + 7])]
        assert got == want and None in want and any(want)


def test_alignment_by_documents(spark):
    table = spark.createDataFrame([(1, "red red red"), (2, "red blue")], "doc_id long, text string")
    most = lambda by: alignment.align_tokenizers(table, BYTE_VOCABULARY, PIECE_MODEL, by)[1].agg(F.max("count")).first()[0]
    assert most("frequency") == 4 and most("documents") == 2


# Operator 13


def plain_audit(rows, min_docs, top):
    terms = lambda t: [lower(x) for x in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v, sources = len(kept), [s for x, s in groups if x == lang]

        def shares(count, kept=kept, v=v):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            used = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            for part, found in (("pair", pairs), ("term", used[:top])):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,min_docs,held", [(1, 1, 200_000), (2, 3, 5), (3, 10, 1)])
def test_source_audit(spark, seed, min_docs, held, monkeypatch):
    monkeypatch.setattr(source_audit, "HELD_TERMS", held)
    rng = random.Random(seed)
    pool = ["one", "Two", "TWO", "three", "É", "é", "x1y", "日本", "_", "a b", "five", *(f"w{c}" for c in "abcdefgh")]
    rows = [
        (rng.choice(["en", "de", "EN", None]), rng.choice(["s1", "s2", "S2", "é", "", None, "big", "big"]), rng.choice([None, "", "1 2 3", *[" ".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(6)]]))
        for _ in range(150)
    ]
    rows += [("fr", "only", "mot"), ("xx", "s1", None), ("xx", "s2", "")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    table = table.withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).repartition(3)
    got = source_audit.audit_sources(table, min_docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, min_docs, 10)


def test_source_audit_of_odd_tables(spark):
    schema = "lang string, source string, text string"
    assert source_audit.audit_sources(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None)] * 2 + [("", "b", "word " * 200_000), ("", "b", "x" * 500_000)]
    got = source_audit.audit_sources(spark.createDataFrame(rows, schema), min_docs=1)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 1, 10)


def test_exact_shares(spark):
    n, total, kept = 10**12 + 7, 3 * 10**13 + 1, 10**8
    made = spark.range(1).select(source_audit.probability(*(F.lit(x).cast("long") for x in (n, total, kept)))).first()[0]
    assert made == 1 + 10**9 * (n + 2) // (total + 2 * kept)
    got = spark.range(1).select(source_audit.divergence(F.lit(10**9 + 1).cast("long"), F.lit(1).cast("long")).alias("f")).first().f
    assert got == (10**9) ** 2 // (10**9 + 2)


# Shared helpers


def test_batches_are_bounded_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 100] * 30 + ["y" * 5000, None, ""], "n": list(range(33))})
    parts = list(common.small_batches([batch], rows=20, size=1000))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert max(p.num_rows for p in parts) == 10 and [p.num_rows for p in parts if p.num_rows == 1]
    assert list(common.small_batches([batch.slice(0, 0)])) == []


def test_scratch_blocks_of_threads_keep_apart(spark):
    kept, ready = {}, threading.Barrier(2)

    def run(name, first):
        with common.scratch(spark):
            df = common.stash(spark.range(5))
            ready.wait()
            if not first:
                ready.wait()
            kept[name] = df.count()
        if first:
            ready.wait()

    threads = [threading.Thread(target=run, args=x) for x in (("a", True), ("b", False))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert kept == {"a": 5, "b": 5}
