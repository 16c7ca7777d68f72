"""Line runs, the hash tree and periodic runs: against SQL, brute force, odd rows and empty tables."""

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from touchpath.llm import linededup, merkle, runs
from touchpath.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_line_runs", "op12_merkle_blocks"])
def test_equals_sql(spark, folder, db, name):
    assert compare.difference(QUERIES[name](spark, folder), ORACLE[name], db) is None


# --- lines --------------------------------------------------------------------


def plain_lines(rows, least_chars, least_documents):
    strip = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
    holders = defaultdict(set)

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), strip.sub("", line))

    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if doc_id is None or len(holders[key(line)]) < least_documents or max(holders[key(line)]) == doc_id
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_table(spark):
    rng = np.random.default_rng(5)
    parts = ["Ünder", " \t", "a", "A", "bb", "\x0b", " ", "\n", "", "same line here", " Same LINE here\r"]
    rows = [(int(i), "\n".join(rng.choice(parts, rng.integers(0, 6)))) for i in rng.integers(0, 90, 150)]
    rows += [(None, "bb\nsame line here"), (7, None), (8, ""), (9, "\n"), (400, "x" * 50_000 + "\nbb")]
    rows += [(500 + i, "everywhere\nonly %d" % i) for i in range(300)]
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], "doc_id long, text string, owner string, h1 int, n int")
    return rows, frame.repartition(5)


@pytest.mark.parametrize("batches", [1, 6])
def test_lines_by_brute_force(spark, batches):
    rows, frame = line_table(spark)
    found = linededup.without_common_lines(frame, 2, 3, batches)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted((tuple(row) for row in found.collect()), key=repr) == plain_lines(rows, 2, 3)


def test_runs_are_levelled_and_move_nothing(spark):
    rows = [(batch * 10 + i, (batch * i) % 17, i % 5) for batch in range(10) for i in range(10)]
    lines = spark.createDataFrame(rows, "doc_id long, h1 long, h2 long").distinct()
    index = linededup.Runs(spark, fan=3)
    want = defaultdict(list)
    for batch in range(9, -1, -1):
        held = lines.where(f"doc_id div 10 = {batch}")
        for row in held.collect():
            want[row.h1, row.h2].append(row.doc_id)
        index.add(held)
        assert all(len(level) < 3 for level in index.levels)
    assert [len(level) for level in index.levels] == [1, 0, 1]  # ten batches: nine merged twice, and one
    owners = defaultdict(list)
    for run in index.runs:
        for row in run.where("owner is not null").collect():
            owners[row.h1, row.h2].append(row.owner)
    assert owners == {key: [max(ids)] for key, ids in want.items()}
    found = {(row.h1, row.h2): (row.owner, row.n) for row in index.merged().collect()}
    assert found == {key: (max(ids), len(ids)) for key, ids in want.items()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one, two = index.runs
        plan = one.where("n > 0").join(two.select("h1", "h2"), ["h1", "h2"], "left_anti").hint("merge")
        with_merge = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning" not in with_merge
    index.close()
    assert index.merged() is None


def test_lines_of_odd_rows_and_empty_tables(spark, odd):
    assert linededup.without_common_lines(odd).count() == odd.count()
    assert linededup.without_common_lines(odd.limit(0)).collect() == []


# --- hash tree ----------------------------------------------------------------


def h(text):
    return sha256(text.encode()).hexdigest()


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        out += level[i ^ 1 : (i ^ 1) + 1]
        i //= 2
    return out


def plain_manifest(rows):
    """Per leaf: (doc_id, leaf, subroot, root, hash of its siblings)."""

    def digest(row):
        values = (row.doc_id, row.source, row.lang, row.n_chars, row.text)
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = defaultdict(list)
    for row in rows:
        trees[row.lang].append((row.doc_id is not None, row.doc_id or 0, digest(row), row))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    inner = {name: up([leaf[2] for leaf in sorted(trees[name], key=lambda x: x[:3])]) for name in names}
    outer = up([inner[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for i, leaf in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            proof = beside(inner[name], i) + beside(outer, place)
            out.append((leaf[3].doc_id, leaf[2], inner[name][-1][0], outer[-1][0], h("".join(proof))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 2, 3, 10])
def test_manifest_by_brute_force(spark, odd, block):
    rows = odd.collect()
    rows += [odd.where("doc_id = 5").first()] * 3
    more = spark.createDataFrame(rows, odd.schema).unionByName(
        spark.range(100, 137).select(
            F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("é"), F.col("id") % 2).alias("lang"),
            F.lit(None).cast("string").alias("source"), F.lit(5).cast("bigint").alias("n_chars"), F.lit("x").alias("kept"),
            F.lit(1).cast("bigint").alias("n"), F.lit(2.0).alias("size"),
        )
    )
    found = merkle.document_manifest(more, block).collect()
    mine = [(r.doc_id, r.leaf, r.subroot, r.root, h(re.sub("[LR,-]", "", r.proof))) for r in found]
    assert sorted(mine, key=repr) == plain_manifest(more.collect())
    chars = {row.doc_id: row.n_chars for row in more.collect()}
    for row in found:
        tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
        assert row.verified == (not tampered or chars[row.doc_id] is None)
        assert merkle.fold(row.leaf, row.proof) == row.root


def test_manifest_of_an_empty_table(odd):
    found = merkle.document_manifest(odd.limit(0))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    assert found.collect() == []


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_of_a_block(levels):
    places = merkle._addresses(levels)
    assert sorted(place for row in places for place in row) == list(range(2**levels - 1))
    # an aligned subtree of half the height lies in one piece
    lower = levels - levels // 2
    for root in range(1 << levels // 2):
        if lower < levels:
            inside = [p for d in range(lower) for p in places[levels // 2 + d][root << d : (root + 1) << d]]
            assert max(inside) - min(inside) + 1 == len(inside) == 2**lower - 1


# --- periodic runs ------------------------------------------------------------


def plain_runs(words, least):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j - i + period >= max(least, 2 * period):
                found.setdefault((i, j - i + period), period)
            i = max(j, i + 1)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_sequences():
    rng = np.random.default_rng(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(0, 90))
            words = rng.integers(0, rng.integers(1, 5), n)
            if n > 20 and rng.random() < 0.5:
                a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
                p = min(p, n - a)
                words = np.array([words[a + (i - a) % p] if i >= a else words[i] for i in range(n)])
            texts.append(words.astype(np.int64))
        for least in (1, 2, 12):
            for words, found in zip(texts, runs.find_runs(texts, least)):
                want = plain_runs(words, max(2, least))
                assert [tuple(map(int, row)) for row in found] == want


def test_agreement_by_brute_force():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 3, n) for n in (1, 40, 7, 200)] + [np.zeros(64, int), np.tile([1, 2], 33)]
    grammar = runs.Grammar([s.astype(np.int64) for s in sequences])
    text = grammar.text.tolist()
    inside = [range(start, start + len(s)) for start, s in zip(grammar.offsets.tolist(), sequences)]
    places = np.array([(i, j) for part in inside for i in part for j in part if i != j])
    ahead, behind = grammar.ahead(*places.T), grammar.behind(*places.T)
    for (i, j), forward, backward in zip(places.tolist(), ahead.tolist(), behind.tolist()):
        n = 0
        while i + n < len(text) and j + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        m = 0
        while i - m - 1 >= 0 and j - m - 1 >= 0 and text[i - m - 1] == text[j - m - 1]:
            m += 1
        assert (forward, backward) == (n, m)


def plain_op13(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    check = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and check % 10 == 0 and n:
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        h("".join(f"{s},{l},{q}\n" for s, l, q in found)), h(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_op13_by_brute_force(spark, folder):
    # every document of up to 1,500 words; longer ones are too slow to compare word by word
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op13_recompression_runs"](spark, folder)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names
    rows = {row.doc_id: tuple(row) for row in found.collect()}
    assert rows.keys() == texts.keys()
    checked = 0
    for doc_id, text in texts.items():
        if len(WORD.findall(text or "")) <= 1_500:
            assert rows[doc_id] == plain_op13(doc_id, text)
            checked += 1
    assert checked > 150


def test_runs_of_odd_rows_and_empty_tables(spark, odd):
    rows = odd.collect()
    found = runs.periodic_runs(odd)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    want = []
    for row in rows:
        words = WORD.findall(row.text or "")
        if len(words) > 1_000:  # the five words of the long text, again and again
            want.append((row.doc_id, len(words), [(0, len(words), 5)], " ".join(words[:5])))
            continue
        each = plain_runs(words, 12)
        gone = {i for s, l, q in each for i in range(s + q, s + l)}
        want.append((row.doc_id or -1 if row.doc_id is None else row.doc_id or -1, len(words), each, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert runs.periodic_runs(odd.limit(0)).collect() == []
    assert runs.with_planted_periods(odd).count() == len(rows)


def test_a_long_text_has_its_own_grammar(monkeypatch):
    monkeypatch.setattr(runs, "WORDS_AT_ONCE", 50)
    texts = [b"a b " * 20, b"", b"x " * 100, b"one two"]
    assert [len(held) for held in runs._portions_of_words(texts)] == [2, 1, 1]


# --- surrogates ---------------------------------------------------------------


def test_a_person_keeps_the_surname(spark):
    from touchpath.llm import pii

    text = "Mr John Smith came. Mr Smith left, Mrs Smith stayed. Mr. John Smith and Dr Jane Roe met Prof Roe and John."
    rows = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, _held string, _row string")
    found = pii.replace(rows).first()
    words = re.findall(r"\w+", found.text)
    john, smith, woman, jane, roe = words[1], words[2], words[8], words[15], words[16]
    assert [words[5], words[11], words[12], words[19]] == [smith, john, smith, roe] and (words[14], words[18]) == ("Dr", "Prof")
    assert len({john, smith, woman, jane, roe, "John", "Smith", "Jane", "Roe"}) == 9 and woman.endswith("na")
    assert found._held == "x" and found._row == "y" and found.n_replaced == 6


def test_surrogates_over_the_whole_table(spark, folder):
    """Detected again by plain Python: each entity has one replacement, no two share one, no original is left."""
    from touchpath.llm import pii

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {row.doc_id: row.text for row in docs.collect()}
    after = {row.doc_id: (row.text, row.n_replaced) for row in pii.replace(docs).collect()}
    found = docs.select("doc_id", pii.matches_of(F.col("text")).alias("found")).collect()
    forward, total = defaultdict(set), 0
    for row in found:
        text, n = after[row.doc_id]
        assert n == len(row.found)
        pieces, rest = [], before[row.doc_id]
        for entity in row.found:
            piece, _, rest = rest.partition(entity)
            pieces.append(piece)
        pattern = "(.+?)".join(map(re.escape, [*pieces, rest]))
        match = re.fullmatch(pattern, text, re.DOTALL)
        assert match
        for entity, new in zip(row.found, match.groups()):
            forward[re.sub(r"\D", "", entity)[-10:] if re.fullmatch(r"[\d +().-]+", entity) else entity.lower()].add(
                re.sub(r"\D", "", new)[-10:] if re.fullmatch(r"[\d +().-]+", entity) and "." not in entity else new.lower()
            )
            total += 1
    assert total > 20 and all(len(news) == 1 for news in forward.values())
    assert len({next(iter(news)) for news in forward.values()}) == len(forward)


# --- archives -----------------------------------------------------------------


def _segment(number, origin, block, total=None):
    first = number == 1
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if first else 'continuation'}",
        f"WARC-Record-ID: <{origin if first else f'{origin}/{number}'}>", f"WARC-Segment-Number: {number}",
    ]
    lines += [] if first else [f"WARC-Segment-Origin-ID: <{origin}>"]
    lines += [f"WARC-Segment-Total-Length: {total}"] if total is not None else []
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def test_broken_records_are_reported(spark, tmp_path):
    import gzip

    from touchpath.llm import warc

    block = b"HTTP/1.1 200 OK\r\n\r\nhello world"
    parts = [block[:10], block[10:25], block[25:]]

    def cut(origin, numbers, total=len(block)):
        return [_segment(n, origin, parts[n - 1], total if n == 3 else None) for n in numbers]

    records = cut("urn:page:1:a", [3, 1, 2])  # out of order is no fault
    records += cut("urn:page:2:a", [2, 3]) + cut("urn:page:3:a", [1, 3]) + cut("urn:page:4:a", [1, 2, 2, 3])
    records += cut("urn:page:5:a", [1, 2, 3], total=5) + cut("urn:page:6:a", [1, 2])
    records += [b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x:y>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"]
    (tmp_path / "a.gz").write_bytes(b"".join(map(gzip.compress, records)))
    found = {row.page_id: row for row in warc.read_archives(spark, str(tmp_path)).collect()}
    assert bytes(found[1].payload) == b"hello world" and found[1].problem is None
    missing, length = "segments are missing or repeated", "the total length is another"
    assert {page: row.problem for page, row in found.items() if page != 1} == {2: missing, 3: missing, 4: missing, 5: length, 6: length}
    assert all(row.payload is None for page, row in found.items() if page != 1) and found[2].record_type == "continuation"


def test_responses_do_not_meet_by_what_they_refer_to(spark, folder):
    plan = QUERIES["op10_warc_segments"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    responses = plan.split("Join")[0]
    assert plan.count("Join") == 1 and "Union" in responses


def test_deduplication_with_a_column_named_like_its_own(spark):
    from touchpath.llm import minhash

    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 7), (2, text, 8), (3, "a b c d e f g", 9), (3, "a b c d e f g", 9), (4, None, 1), (None, text, 2)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, _id int")
    found = minhash.deduplicated(documents)
    assert found.columns == documents.columns
    assert sorted((row["doc_id"] or 0, row["_id"]) for row in found.collect()) == [(0, 2), (1, 7), (3, 9), (4, 1)]
