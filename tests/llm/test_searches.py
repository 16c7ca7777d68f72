"""Alike texts by their signatures, splits of the k-d tree, and columns named like the operators' own."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchpath.llm import chunkdedup, minhash, pii, sharding, spotsigs
from touchpath.llm.queries import QUERIES


def plain_signatures(text: str) -> set[tuple[str, ...]]:
    """Chains after listed words, written out for texts in which these are frequent."""
    words = [word for word in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if word]
    found = set()
    for i, word in enumerate(words):
        chain = [other for other in words[i + 1 :] if other not in spotsigs.ANCHORS][: spotsigs.CHAIN]
        if word in spotsigs.ANCHORS and len(chain) == spotsigs.CHAIN:
            found.add((word, *chain))
    return found


def test_signatures_are_the_chains(documents):
    compared = 0
    for row in documents.collect():
        words = re.findall(r"[A-Za-z]+", row.text or "")
        if words and 4 * sum(word.lower() in spotsigs.ANCHORS for word in words) > len(words):
            expected = plain_signatures(row.text)
            if expected:
                compared += 1
                assert len(spotsigs.signatures(row.text.encode())) == len(expected)
    assert compared > 50


def test_languages_without_listed_words_have_chains():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("бвгдежзик"), 6)) for _ in range(400)]
    whole, edited = (spotsigs.signatures(" ".join(part).encode()) for part in (words, words[:300] + words[:100]))
    assert len(whole) > 20 and spotsigs.similarity(whole, edited) > 0.5


def brute_force(sets: dict[int, set], percent: int = 80) -> dict[int, int]:
    """The smallest id that each id reaches."""
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sorted(sets) if sets[i]]
    for x, one in enumerate(ids):
        for other in ids[x + 1 :]:
            if 100 * len(sets[one] & sets[other]) >= percent * len(sets[one] | sets[other]):
                low, high = sorted((top(one), top(other)))
                root[high] = low
    return {i: top(i) for i in sets}


def test_alike_texts_by_brute_force(spark, folder, documents):
    sets = {row.doc_id: set(spotsigs.signatures((row.text or "").encode()).tolist()) for row in documents.collect()}
    found = QUERIES["spot_near_duplicates"](spark, folder).collect()
    expected = brute_force(sets)
    assert {row.doc_id: (row.n, row.component_id, row.kept) for row in found} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in sets
    }


def test_alike_texts_of_every_size_by_brute_force(spark):
    """Copies with more and more words changed, from short ones to long ones, and phrases that all share."""
    rng = np.random.default_rng(5)
    texts = {}
    for length in (8, 20, 50, 120, 300):
        for _ in range(6):
            base = [f"the w{rng.integers(5_000)}" for _ in range(length)]
            for changes in rng.integers(0, 1 + length // 6, 6):
                words = list(base)
                for at in rng.integers(0, length, changes):
                    words[at] = f"the w{rng.integers(5_000)}"
                texts[len(texts)] = " ".join(words) + " and so it is said in the common ending phrase of all"
    sets = {i: set(spotsigs.signatures(text.encode()).tolist()) for i, text in texts.items()}
    expected = brute_force(sets)
    assert 20 < len(set(expected.values())) < len(texts) - 20
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {row.doc_id: row.component_id for row in spotsigs.near_duplicates(rows).collect()} == expected


def test_alike_texts_of_odd_rows_and_empty_tables(odd):
    rows = spotsigs.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and all(row.kept for row in rows if row.doc_id is None)
    assert {row.component_id for row in rows if row.doc_id in (5, 6)} == {5}
    assert spotsigs.near_duplicates(odd.limit(0)).collect() == []


def test_names_are_numbered_in_order(spark):
    names = [None, "", "common_crawl_a", "common_crawl_b", "common_wiki", "z", "é", "中", "\U0001f600"]
    rows = spark.createDataFrame([(name,) for name in names[::-1] * 3], "name string").repartition(5)
    found = {row.name: row.number for row in sharding.numbered(rows.select(F.col("name").alias("source"))).select(F.col("name").alias("name"), "number").collect()}
    assert found == {name: i for i, name in enumerate(names)}
    assert sharding.numbered(rows.limit(0)).collect() == []


def test_splits_are_weighted_medians(documents):
    named = documents.withColumn("source", F.concat(F.lit("common_crawl_"), F.coalesce("source", F.lit("none"))))
    table = sharding.metadata(named)
    n = len(sharding.DIMENSIONS)
    tree, rows = sharding.grow(table.drop("text_crc32", "doc_id"), sharding.DIMENSIONS, 8)
    values = np.array([list(row)[: n + 1] for row in table.collect()])
    assert rows == len(values) and len(set(values[:, 0])) == named.select("source").distinct().count()
    widths = np.maximum(1, values[:, :n].max(0) - values[:, :n].min(0))
    own = {0: np.arange(rows)}
    splits = 0
    for place, node in enumerate(tree):
        if not node.children:
            continue
        splits += 1
        here = values[own[place]]
        assert node.dimension == int(np.argmax((here[:, :n].max(0) - here[:, :n].min(0)) / widths))
        weights = defaultdict(int)
        for row in here:
            weights[row[node.dimension], row[n - 1]] += row[n]
        want, before, left = here[:, n].sum() * (node.shards // 2) // node.shards, 0, set()
        for key in sorted(weights):
            if before + weights[key] >= want:  # the document on the border goes to the nearer side
                if before + weights[key] - want <= want - before:
                    left.add(key)
                break
            before += weights[key]
            left.add(key)
        goes = np.array([(row[node.dimension], row[n - 1]) in left for row in here])
        for child, chosen in zip(node.children, (goes, ~goes)):
            own[child] = own[place][chosen]
        at = sharding._leaves([sharding.Node(0, 2, node.dimension, node.at, node.inclusive, [1, 2]), sharding.Node(0, 1), sharding.Node(1, 1)], here[:, :n])
        assert ((at == 1) == goes).all()
    assert splits == 7


OWN = ["_id", "_source", "_copies", "_turn", "_spans", "_held", "_row", "_new", "_found", "_pieces", "lang_pred", "score", "held_out"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_named_like_their_own(spark, documents, stage):
    named = documents.where("doc_id < 60").select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in OWN])
    found = dict(corpus_pipeline.STAGES)[stage](spark, named, "")
    assert found.columns == named.columns
    rows = found.collect()
    assert rows and all(row[name] == f"{name} {row.doc_id}" for row in rows for name in OWN)


def test_operators_keep_columns_named_like_their_own(documents):
    named = documents.where("doc_id < 60").select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in OWN])
    for found in (chunkdedup.without_passages(named, chunkdedup.passages(named)), pii.replace(named).drop("n_replaced")):
        rows = found.collect()
        assert found.columns == named.columns and len(rows) == named.count()
        assert all(row[name] == f"{name} {row.doc_id}" for row in rows for name in OWN)


def test_copies_that_fail_the_limit_by_little_are_told_apart_by_their_core(spark, monkeypatch):
    """Copies that lack a stretch of a text are not compared with each of its near copies."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for _ in range(60):
        words = list(base)
        for at in rng.choice(150, 2, replace=False):
            words[at] = f"x{rng.integers(10**9)}"
        texts[len(texts)] = " ".join(words)
    for _ in range(25):
        start = int(rng.integers(0, 126))
        texts[len(texts)] = " ".join(base[:start] + base[start + 24 :])
    sets = {i: {tuple(words[j : j + 5]) for j in range(len(words) - 4)} for i, words in ((i, text.split()) for i, text in texts.items())}
    compared, plain = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda pairs, *more: compared.append(pairs.count()) or plain(pairs, *more))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in minhash.near_duplicates(rows).collect()}
    assert found == brute_force(sets)
    assert sum(compared[1:]) <= 25 * 24 / 2, compared  # the long ones at most among themselves


def test_copies_that_went_different_ways_are_told_apart_by_a_bitmap(spark, monkeypatch):
    """Copies whose changes others have made, too, but no other the same ones, are not compared with each of them."""
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for changes in [6] * 60 + [10] * 40:  # within the limit of the first, and beyond it
        words = list(base)
        for at in rng.choice(150, changes, replace=False):
            words[at] = f"x{at}_{rng.integers(3)}"
        texts[len(texts)] = " ".join(words)
    sets = {i: set(zip(words, words[1:])) for i, words in ((i, text.split()) for i, text in texts.items())}
    compared, plain = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda pairs, *more: compared.append(pairs.count()) or plain(pairs, *more))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in minhash.near_duplicates(rows, shingle=2).collect()}
    assert found == brute_force(sets)
    assert sum(compared[1:]) <= 100, compared


def test_bitmaps_bound_what_two_sets_share(spark):
    rng = np.random.default_rng(13)
    sets = [[int(x) for x in rng.choice(np.arange(-400, 400) * 10**15 + 63, size, replace=False)] for size in (0, 1, 5, 60, 300, 500)]
    pairs = [(one, other, len(set(one) & set(other))) for one in sets for other in sets]
    rows = spark.createDataFrame(pairs, "a array<long>, b array<long>, shared long")
    bound = minhash._shared_cells("x", "y").alias("bound")
    found = rows.select("shared", F.least(F.size("a"), F.size("b")).alias("n"), minhash._cells("a").alias("x"), minhash._cells("b").alias("y"))
    for row in found.select("shared", "n", bound).collect():
        assert row.shared <= row.bound and (row.n > 5 or row.bound <= row.n)
