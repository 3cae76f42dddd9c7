"""Decontamination, sharding, substring dedup, mixing, n-gram join and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millsight.llm import decontaminate, graph, mixing, ngram_join, sharding, substring_dedup
from millsight.llm.common import shingles
from millsight.llm.queries import QUERIES


def distance_inside(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any stretch of the text, by the plain recurrence."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for char in text:
        now = [0]
        for i, p in enumerate(pattern, 1):
            now.append(min(row[i - 1] + (p != char), row[i] + 1, now[i - 1] + 1))
        row = now
        best = min(best, row[-1])
    return best


def test_myers_equals_the_recurrence():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert decontaminate.myers(pattern, text)[0] == distance_inside(pattern, text)


def edited(text: str, edits: int, rng: random.Random) -> str:
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = "q"
        elif kind == 1:
            chars.insert(at, "q")
        else:
            del chars[at]
    return "".join(chars)


def test_matches_equal_brute_force():
    rng = random.Random(2)
    words = ["ab", "cde", "fgh", "ijkl", "mn", "opq"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, decontaminate.normalised(text(rng.randint(1, 25)))) for i in range(8)]
    matcher = decontaminate.Matcher(items)
    for _ in range(25):
        _, item = rng.choice(items)
        body = f"{text(8)} {edited(item, rng.randint(0, 6), rng)} {text(8)}"
        plain = decontaminate.normalised(body)
        wanted = {(n, distance_inside(t, plain)) for n, t in items}
        wanted = {(n, d) for n, d in wanted if d <= decontaminate.budget(dict(items)[n])}
        assert {(n, d) for n, d, _ in matcher.matches(body)} == wanted


def test_decontamination_of_odd_rows(odd_documents, frame, monkeypatch):
    items = frame("item_id long, text string", (1, "One, two THREE!"), (2, None), (3, "--"), (4, "one two three"))
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", 5)  # several passes
    found = decontaminate.find_items(odd_documents, items, carry=("doc_id", "key"))
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found.collect()) == [(None, 1, 0), (None, 4, 0)]
    kept = decontaminate.drop_contaminated(odd_documents, items)
    assert kept.columns == odd_documents.columns and kept.count() == 8
    assert decontaminate.find_items(odd_documents, items.limit(0)).count() == 0


def test_decontamination_with_clashing_names(frame):
    """Columns named like the operator's own are carried as they are."""
    items = frame("item_id long, text string", (1, "one two three four"))
    schema = "doc_id long, text string, _text string, _key string, distance int, item_id string"
    documents = frame(schema, (1, "say one two three four now", "t", "k", 7, "i"), (2, "other words", "t", "k", 8, "j"))
    kept = decontaminate.drop_contaminated(documents, items)
    assert [tuple(r) for r in kept.collect()] == [(2, "other words", "t", "k", 8, "j")]
    found = decontaminate.find_items(documents, items, carry=("_text", "_key", "doc_id"))
    assert found.columns == ["_text", "_key", "doc_id", "item_id", "distance", "end_char"]
    assert [tuple(r)[:5] for r in found.collect()] == [("t", "k", 1, 1, 0)]


def test_a_large_benchmark_is_taken_in_passes(spark, frame, monkeypatch):
    """The chunk bounds what is broadcast; every pass is written and its broadcast given up."""
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", 2000)
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(12))) for i in range(200)]
    documents = [(i, f"before it {items[i][1]} after it") for i in range(0, 200, 9)]
    found = decontaminate.find_items(
        frame("doc_id long, text string", *documents, (-1, "nothing of it")),
        frame("item_id long, text string", *items).repartition(3),
    )
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(0, 200, 9)]


def test_decontamination_of_the_table(spark, folder, rows_of):
    found = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_decontamination"](spark, folder).collect()}
    items = [(i, decontaminate.normalised(t)) for i, t in rows_of("benchmark", "item_id", "text")]
    exact = set()
    for doc_id, text in rows_of("documents", "doc_id", "text"):
        plain = decontaminate.normalised(text)
        exact |= {(doc_id, i) for i, item in items if item in plain}
    assert exact and exact <= found


def check_shards(rows, shards=8):
    total = sum(r.size for r in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    most = max((r.size for r in rows), default=0)
    assert all(abs(sizes[s] - total / shards) <= most for s in range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_the_table(spark, folder, rows_of):
    rows = QUERIES["op4_sharding"](spark, folder).collect()
    texts = dict(rows_of("documents", "doc_id", "text"))
    check_shards(rows)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "bytes", None)
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in ordered] == sorted(texts)


def test_shards_by_the_plain_law(spark, folder, rows_of):
    """Bytes before a row in (key, text hash) order decide its shard: recomputed row by row."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    placed = documents.selectExpr("doc_id", "shiftrightunsigned(xxhash64(text), 11) AS h", "octet_length(text) + 1 AS size")
    rows = sorted(tuple(r) for r in placed.collect())
    total, before, wanted, slots = sum(r[2] for r in rows), 0, {}, Counter()
    for doc_id, _, size in rows:
        middle = before + before + size  # twice the middle of the row
        shard = min(7, middle * 8 // (2 * total))
        wanted[doc_id] = (shard, slots[shard])
        slots[shard] += 1
        before += size
    found = {r.doc_id: (r.shard, r.slot) for r in QUERIES["op4_sharding"](spark, folder).collect()}
    assert found == wanted


def test_hot_keys_and_equal_rows_are_split(spark, frame):
    rows = [(1 if i % 3 else i, "same" if i % 2 else f"text {i}") for i in range(4000)]
    rows += [(7, "twin")] * 3000 + [(None, None)] * 50
    found = sharding.assign_shards(frame("doc_id long, text string", *rows), carry=("text",), pieces=8).collect()
    check_shards(found)
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, r.text)) for r in found)


def test_shards_of_odd_rows(odd_documents):
    carry = ("source", "size", "key", "_row", "shard")
    odd = odd_documents.withColumnsRenamed({"size": "size_", "shard": "shard_"})
    found = sharding.assign_shards(odd, carry=("source", "size_", "key", "_row", "shard_")).collect()
    assert len(found) == 9 and {r.shard_ for r in found} == {1} and len(carry) == 5
    assert sharding.assign_shards(odd_documents.limit(0)).count() == 0


def test_mix_meets_targets(spark, frame):
    rows = [(i, " ".join(["w"] * (i % 37)), None if i % 9 == 0 else f"s{i % 3 if i % 2 else 0}") for i in range(600)]
    rows += [(5, "a b c", "s1")] * 20 + [(None, None, "s2"), (None, "x y", "s2"), (8, "", "empty")]
    documents = frame("doc_id long, text string, source string", *rows)
    dealt = mixing.mix(documents, block_words=64, carry=("text",))
    docs, sources = dealt.documents.collect(), {r.source: r for r in dealt.sources.collect()}
    assert sorted(str((r.doc_id, r.text, r.source)) for r in docs) == sorted(str(r) for r in rows)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in order}
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, rest, left = {}, set(order), float(sum(sizes.values()))
    while True:  # reshare the excess until none is above
        level = left / sum(weights[s] for s in rest)
        over = {s for s in rest if level * weights[s] > 3 * sizes[s]}
        target.update({s: 3.0 * sizes[s] for s in over})
        rest -= over
        left -= sum(3.0 * sizes[s] for s in over)
        if not over:
            break
    target.update({s: level * weights[s] for s in rest})
    taken = Counter()
    for r in docs:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.size == len((r.text or "").split())
    for s in order:
        assert sources[s].source_size == sizes[s]
        assert sources[s].target == pytest.approx(target[s])
        assert abs(taken[s] - target[s]) <= 0.5
    again = mixing.mix(documents, block_words=64).documents
    assert sorted((r.doc_id or -1, r.taken) for r in again.collect()) == sorted((r.doc_id or -1, r.taken) for r in docs)
    pieces = dealt.pieces.collect()
    blocks = {(p.source_no, p.block): p.shard for p in pieces}
    assert all(blocks[p.source_no, p.block] == p.shard for p in pieces)
    held = Counter(blocks.values())
    assert max(held.values()) - min(held[s] for s in range(8)) <= 3


def test_splitting_tree_is_hypergeometric(frame):
    """Left counts of the first cut have the mean and variance of the multivariate hypergeometric law."""
    quota = {1: 40, 2: 24}
    blocks = frame("source_no int, block int", *[(s, b) for s, n in quota.items() for b in range(n)])
    left = []
    for seed in range(6):
        dealt = mixing._deal(blocks, 1, seed).filter("shard = 0").groupBy("source_no").count().collect()
        counts = {r[0]: r[1] for r in dealt}
        assert sum(counts.values()) == 32
        left.append(counts[1])
    assert abs(np.mean(left) - 20) < 3.2 and np.var(left) < 16  # expected 20 and 3.81


def test_mix_of_nothing(odd_documents):
    dealt = mixing.mix(odd_documents.limit(0))
    assert dealt.documents.count() == dealt.sources.count() == dealt.pieces.count() == 0
    assert mixing.mix(odd_documents).documents.count() == 9


def test_components_by_brute_force(frame):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 540)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    found = {r.node: r.component for r in graph.components(frame("a long, b long", *edges)).collect()}
    assert {x for x in parent if any(x in e and e[0] != e[1] for e in edges)} == set(found)
    for a in found:
        for b in found:
            assert (found[a] == found[b]) == (root(a) == root(b))


def brute_near(rows):
    """(class_id, text_class, n_copies, n_links) per row by comparing all pairs of texts."""
    sets, least, copies = {}, {}, Counter(t or "" for _, t in rows)
    for doc_id, text in rows:
        text = text or ""
        sets.setdefault(text, set(shingles(text.encode().split()).tolist()))
        ids = [x for x in (least.get(text), doc_id) if x is not None]
        least[text] = min(ids) if ids else None
    names = list(sets)
    parent, links = {t: t for t in names}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    group = defaultdict(list)
    for t in names:
        group[root(t)].append(least[t])
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in group.items()}
    return [(d, smallest[root(t or "")], least[t or ""], copies[t or ""], links[t or ""]) for d, t in rows]


def family_rows():
    rng = random.Random(6)
    rows = []
    for base in range(40):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(6, 160))]
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(900 + i, t) for i, t in enumerate(["", " ", None, "a b", "a  b", "a b c d e", "c"])]
    return [*rows, (3, rows[3][1]), (None, rows[4][1]), (None, "only without an id")]


def test_near_duplicates_by_brute_force(spark, frame, monkeypatch):
    rows = family_rows()
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)  # families larger than a block
    documents = frame("doc_id long, text string, family string, key int, label int", *[(*r, "f", 1, 2) for r in rows])
    found = ngram_join.near_duplicates(documents, carry=("family", "key", "label"))
    found = [(r.doc_id, r.class_id, r.text_class, r.n_copies, r.n_links) for r in found.collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute_near(rows)))
    assert ngram_join.near_duplicates(documents.limit(0)).count() == 0


def test_prefix_depth_meets_the_recall():
    depth = ngram_join.final_depth(0.8)
    assert 1 - (1 - 0.8**depth) ** ngram_join.TREES >= 0.9999
    assert 1 - (1 - 0.8 ** (depth + 1)) ** ngram_join.TREES < 0.9999


def test_labels_estimate_similarity():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 2**63, 1000).astype(np.uint64)
    one, two = (np.frombuffer(ngram_join.minhash_label(v), "<u2") for v in (values[:900], values[100:]))
    assert abs((one == two).mean() - 0.8) < 0.12


def brute_chain(left, right):
    """The best chain value by the quadratic recurrence."""
    order = sorted(range(len(left)), key=lambda i: left[i])
    value = {}
    for i in order:
        before = [
            value[j] - substring_dedup.GAP_COST * (left[i] - left[j] + right[i] - right[j])
            for j in value
            if left[j] < left[i] and right[j] < right[i]
        ]
        value[i] = 1 + max([0.0, *before])
    return max(value.values())


def test_fenwick_chaining_equals_the_recurrence():
    rng = np.random.default_rng(9)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        left, right = rng.integers(0, 60, n), rng.integers(0, 60, n)
        best = substring_dedup.chains(left, right)[0]
        x, y = left[best], right[best]
        assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
        gaps = substring_dedup.GAP_COST * (x[-1] - x[0] + y[-1] - y[0])
        assert len(best) - gaps == pytest.approx(brute_chain(left.tolist(), right.tolist()))


def test_chains_of_matches_in_step_equal_the_search():
    rng = np.random.default_rng(19)
    for _ in range(60):
        steps = rng.integers(1, 12, (2, int(rng.integers(1, 30))))
        left, right = steps.cumsum(1)
        chain = substring_dedup.chains(left, right)
        # A match far off both ways keeps the search from being left out.
        found = substring_dedup.chains(np.append(left, 10**6), np.append(right, -(10**6)))
        assert chain == [c for c in found if len(left) not in c]


def test_repeated_passages(spark, frame):
    rng = random.Random(10)

    def words(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    exact, fuzzy, short = words(60), words(80), words(30)
    rows, planted = [], {}
    for i in range(60):
        body, inserted = words(rng.randint(80, 200)), None
        if i % 4 == 0:
            inserted = list(exact)
        elif i % 4 == 1:
            inserted = list(fuzzy)
            for at in (20, 45, 60):
                inserted[at] = f"y{i}"
        elif i % 4 == 2:
            inserted = list(short)
        at = rng.randrange(len(body))
        if inserted:
            body[at:at] = inserted
        if inserted and len(inserted) > 50:
            planted[i] = (at, at + len(inserted))
        rows.append((i, " ".join(body)))
    rows += [(100, rows[3][1]), (101, None), (None, ""), (None, rows[7][1])]
    documents = frame("doc_id long, text string, id int, start int", *[(*r, 1, 2) for r in rows])
    found = defaultdict(list)
    for r in substring_dedup.repeated_passages(documents).collect():
        found[r.doc_id].append((r.start_word, r.end_word))
    assert set(found) == set(planted) | {3, 100, 7, None}
    for i, (start, end) in planted.items():
        [(a, b)] = found[i]
        assert abs(a - start) <= 1 and abs(b - end) <= 1
    assert found[3] == found[100] == [(0, len(rows[3][1].split()))]
    assert substring_dedup.repeated_passages(documents.limit(0)).count() == 0


def test_passages_need_one_partner_and_short_texts_hide_none(frame):
    rng = random.Random(12)

    def words(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    shared, stock = words(60), [words(14) for _ in range(5)]
    rows = [(0, words(70) + shared + words(50)), (1, words(40) + shared + words(90))]
    rows += [(100 + i, shared[i : i + 11]) for i in range(50)]
    rows += [(20 + i, words(30) + line + words(30)) for i, line in enumerate(stock)]
    rows += [(30, [w for line in stock for w in line])]
    documents = frame("doc_id long, text string", *[(i, " ".join(t)) for i, t in rows])
    found = substring_dedup.repeated_passages(documents)
    found = sorted((r.doc_id, r.start_word, r.end_word) for r in found.collect())
    assert found == [(0, 70, 130), (1, 40, 100)]


def test_passages_are_found_behind_any_number_of_texts_with_their_seeds(frame):
    """Texts with every seed of a passage, but not the passage, lie between its two texts in the orders."""
    rng = random.Random(31)

    def words(n):
        return [f"t{rng.randrange(10**6)}" for _ in range(n)]

    shared, changed = words(64), ["x1", "x2"]
    rows = [(0, words(20) + shared + words(20)), (1, words(1500) + shared[:30] + changed + shared[32:] + words(900))]
    for i in range(160):
        half = range(27) if i % 2 else range(27, 54)
        rows.append((10 + i, [w for at in half for w in shared[at : at + 11] + words(25)]))
    found = substring_dedup.repeated_passages(frame("doc_id long, text string", *[(i, " ".join(t)) for i, t in rows]))
    found = sorted((r.doc_id, r.start_word, r.end_word, r.like_doc) for r in found.collect())
    assert found == [(0, 20, 84, 1), (1, 1500, 1564, 0)]


def test_further_matches_equal_the_comparison_of_all_pairs(spark, frame, monkeypatch):
    """Also where the pairs of two seeds are cut into blocks of both sides."""
    monkeypatch.setattr(substring_dedup, "BLOCK_PLACES", 5)
    monkeypatch.setattr(substring_dedup, "CELL_TESTS", 50)
    rng = random.Random(41)
    rows = set()
    for text in range(40):
        for place in rng.sample(range(120), 14):
            sides = [sum(1 << rng.randrange(63) for _ in range(2)) if rng.random() < 0.5 else 0 for _ in range(2)]
            rows.add((rng.randrange(4), text - 20, place, *sides, place, place + rng.choice((0, 0, 0, 35))))
    covered = [(text - 20, 30, 110) for text in range(0, 40, 3)]
    spans = {i: (start, end) for i, start, end in covered}
    pairs = []
    for seed, i, place, _, behind, first, last in rows:
        for seed2, i2, place2, before, _, first2, last2 in rows:
            if i != i2 or not substring_dedup.APART <= place2 - place <= 50:
                continue
            if (seed, first) == (seed2, first2) and last + 5 - first < 32:
                continue
            start, end = spans.get(i, (0, 0))
            lone = any(not (start <= a and b + 5 <= end) for a, b in ((first, last), (first2, last2)))
            pairs.append((seed, seed2, i, place, place2 - place, behind, before, lone))

    def alike(one, two):
        return (one & two).bit_count() >= substring_dedup.ALIKE * min(one.bit_count(), two.bit_count())

    expected = set()
    for one in pairs:
        for two in pairs:
            same = one[-1] and one[:2] == two[:2] and one[2] != two[2] and abs(one[4] - two[4]) <= 8
            if same and alike(one[5], two[5]) and alike(one[6], two[6]):
                expected.add((*max(one[2:4], two[2:4]), *min(one[2:4], two[2:4])))
    places = frame(", ".join(f"{c} long" for c in substring_dedup._PLACE_NAMES), *rows)
    spans = frame("id long, start long, end long", *covered)
    found = []
    for r in substring_dedup._further_matches(places, spans, 8).collect():
        columns = [np.frombuffer(r[f"c{i}"], kind) for i, kind in enumerate(substring_dedup._MATCH_TYPES)]
        found += zip(*(c.tolist() for c in columns), strict=True)
    assert len(expected) > 1000 and set(found) == expected


def test_texts_with_one_line_make_no_rows_for_each_two_of_them(frame, monkeypatch):
    """Lines of 40 words that all texts have, in words of their own: no passage, and rows as the texts."""
    rng = random.Random(42)
    line = [f"l{i}" for i in range(40)]
    rows = {}
    real = substring_dedup.written

    def counted(table, label):
        done = real(table, label)
        rows[label] = rows.get(label, 0) + done.count()
        return done

    monkeypatch.setattr(substring_dedup, "written", counted)
    made = []
    for count in (60, 180):
        rows.clear()
        texts = [[f"o{rng.randrange(10**6)}" for _ in range(30)] for _ in range(count)]
        documents = [(i, " ".join(t[:15] + line + t[15:])) for i, t in enumerate(texts)]
        assert substring_dedup.repeated_passages(frame("doc_id long, text string", *documents)).count() == 0
        made.append((rows["passage-seed-pairs"], rows["passage-further"]))
    assert all(more <= 4 * less for less, more in zip(*made, strict=True))


def test_unlike_gaps_join_nothing(frame):
    """Two texts that share 40 words, differ in the next 60, share 40 again have no passage of 50."""
    rng = random.Random(21)

    def words(n):
        return [f"u{rng.randrange(10**6)}" for _ in range(n)]

    for gap in (30, 60):
        first, last = words(40), words(40)
        rows = [(i, " ".join(words(20) + first + words(gap) + last + words(20))) for i in range(2)]
        assert substring_dedup.repeated_passages(frame("doc_id long, text string", *rows)).count() == 0


@pytest.mark.parametrize("length, changes, recall", [(60, 3, 0.95), (60, 6, 0.9), (100, 10, 0.95), (100, 15, 0.9)])
def test_recall_of_fuzzy_passages(frame, length, changes, recall):
    """Passages with 5, 10 and 15 % of their words changed, one partner each."""
    rng = random.Random(length + changes)

    def words(n):
        return [f"r{rng.randrange(4000)}" for _ in range(n)]

    rows, planted = [], {}
    for i in range(150):
        passage = words(length)
        for copy in range(2):
            mine = list(passage)
            for at in rng.sample(range(length), changes) if copy else ():
                mine[at] = f"changed{rng.randrange(10**6)}"
            before = words(rng.randint(40, 120))
            planted[2 * i + copy] = (len(before), len(before) + length)
            rows.append((2 * i + copy, " ".join(before + mine + words(rng.randint(40, 120)))))
    found = defaultdict(list)
    for r in substring_dedup.repeated_passages(frame("doc_id long, text string", *rows)).collect():
        found[r.doc_id].append((r.start_word, r.end_word))
        start, end = planted[r.doc_id]
        assert r.like_doc == r.doc_id ^ 1 and start - 3 <= r.start_word and r.end_word <= end + 3
    caught = sum(any(b - a >= 50 for a, b in found[i]) for i in planted)
    assert caught >= recall * len(planted)


def test_passages_of_the_table(spark, folder, rows_of):
    texts = dict(rows_of("documents", "doc_id", "text"))
    owners = defaultdict(set)
    for doc_id, text in texts.items():
        words = text.encode().split()
        for i in range(len(words) - 49):
            owners[tuple(words[i : i + 50])].add(doc_id)
    covered = defaultdict(set)
    for r in QUERIES["op5_substring_dedup"](spark, folder).collect():
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
    for doc_id, text in texts.items():
        words = text.encode().split()
        for i in range(len(words) - 49):
            if len(owners[tuple(words[i : i + 50])]) > 1:
                assert covered[doc_id] >= set(range(i, i + 50))


def test_pipeline_by_its_parts(spark, folder, rows_of):
    texts = dict(rows_of("documents", "doc_id", "text"))
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), f"test-{name}")
        seen.append(docs.collect())
        if name != "sharding":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    quality, near, clean, mixed, placed = seen
    judged = QUERIES["op3_quality_rules"](spark, folder).filter("kept").collect()
    assert {r.doc_id for r in quality} == {r.doc_id for r in judged} and len(quality) == len(judged)
    groups = brute_near([(r.doc_id, r.text) for r in quality])
    assert sorted(r.doc_id for r in near) == sorted({g[1] for g in groups})
    items = [(i, decontaminate.normalised(t)) for i, t in rows_of("benchmark", "item_id", "text")]
    matcher = decontaminate.Matcher(items)
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in near if not matcher.matches(r.text))
    before, after = Counter(), Counter()
    for r in clean:
        before[r.source] += len(r.text.encode().split())
    for r in mixed:
        after[r.source] += len(r.text.encode().split())
    order = sorted(before)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    share = {s: i % 3 + 1 for i, s in enumerate(order)}
    longest = max(len(t.encode().split()) for t in texts.values())
    level = sum(before.values()) / sum(share.values())
    free = [s for s in order if level * share[s] <= 3 * before[s]]
    assert all(after[s] >= level * share[s] - 1 for s in free)
    assert all(after[s] <= 3 * before[s] for s in order) and longest > 0
    assert sorted(r.doc_id for r in placed) == sorted(r.doc_id for r in mixed)
    check_shards(placed)
    assert all(r.text == texts[r.doc_id] for r in placed)


def test_pipeline_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), f"empty-{name}")
    assert docs.count() == 0
