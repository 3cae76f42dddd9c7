"""Spelling variants, SimHash near-dedup and the Merkle manifest against plain recomputation."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import xxhash

from millsight.llm import merkle, simhash, spelling
from millsight.llm.queries import QUERIES

UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- spelling variants -----------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    """By the plain recurrence."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1] == 1


def brute_words(rows) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER_TO_LOWER)
            key = "" if doc_id is None else str(doc_id)
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return Counter({word: n for word, n in counts.items() if n >= 5})


def brute_variants(counts) -> set[tuple]:
    near = defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for word in words:
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * counts[word] else None
    found = set()
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        chosen = form[word]
        found.add((word, chosen, root, counts[word], len(near[word]), chosen and counts[chosen]))
    return found


VARIANT_COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("group", (1, 3, 512))
def test_variants_by_brute_force(spark, frame, monkeypatch, group):
    """Groups of every size give the same pairs: compared whole, or split by the edit's place."""
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = random.Random(group)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randint(6, 9))) for _ in range(260)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "bababab", "z" * 400, "z" * 401}
    counts = Counter({word: rng.choice((5, 6, 30, 31, 200, 2000)) for word in sorted(words)})
    found = spelling.variants(frame("word string, n long", *counts.items()))
    assert {tuple(r) for r in found.select(*VARIANT_COLUMNS).collect()} == brute_variants(counts)
    assert found.count() == len(counts)


def test_tiles_equal_pairs():
    """A group above the tile size gives the pairs of the recurrence, over block borders."""
    rng = random.Random(5)
    group = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(6, 7))) for _ in range(420)})
    assert len(group) > spelling.TILE
    wanted = {(a, b) for i, a in enumerate(group) for b in group[i + 1 :] if one_edit(a, b)}
    assert {(group[i], group[j]) for i, j, _ in spelling.near_pairs([group])} == wanted


def test_runs_and_counts_of_the_table(spark, folder, rows_of):
    found = spelling.vocabulary(spelling.runs(spark.read.parquet(f"{folder}/documents.parquet")))
    assert dict(map(tuple, found.collect())) == dict(brute_words(rows_of("documents", "doc_id", "text")))


def test_variants_of_odd_rows(odd_documents, frame):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    found = spelling.variants(spelling.vocabulary(spelling.runs(odd_documents)))
    assert {tuple(r) for r in found.select(*VARIANT_COLUMNS).collect()} == brute_variants(brute_words(rows))
    assert spelling.variants(spelling.vocabulary(spelling.runs(odd_documents.limit(0)))).count() == 0


# --- SimHash ---------------------------------------------------------------------------------


def brute_fingerprint(text: str | None) -> int:
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(UPPER_TO_LOWER)) if w]
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest()
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(keys, prints) -> list:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, key in enumerate(keys):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(keys))]


def test_fingerprints_by_definition(monkeypatch):
    monkeypatch.setattr(simhash, "PART", 7)
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 20, 60):
        text = "".join(f"WÉ{rng.randint(0, 9)}{rng.choice((' ', chr(10), '  ', chr(9)))}" for _ in range(n))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_shingles_are_hashed_as_the_built_in_function_does(spark):
    hashed = spark.sql("SELECT xxhash64('a b é') AS h").first().h % 2**64
    assert hashed == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_near_copies_of_the_table(spark, folder, rows_of):
    keys, texts = zip(*rows_of("documents", "doc_id", "text"), strict=True)
    prints = [brute_fingerprint(text) for text in texts]
    wanted = set(zip(keys, (f"{p:016x}" for p in prints), brute_components(keys, prints), strict=True))
    assert {tuple(r) for r in QUERIES["op12_simhash_near_dedup"](spark, folder).collect()} == wanted


@pytest.mark.parametrize("bucket", (0, 3, 64))
def test_links_by_brute_force(frame, monkeypatch, bucket):
    """Families around a few centres fill buckets of either half; every pair within two bits is linked."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(7)
    prints = {0, 2**64 - 1, 2**63, 2**63 + 1, 1, 2**32}
    for _ in range(3):
        centre = rng.getrandbits(64)
        places = rng.sample(range(64), 9)
        for _ in range(60):
            prints.add(centre ^ sum(1 << p for p in rng.sample(places, rng.randint(0, 4))))
        prints |= {centre & (2**32 - 1) | rng.getrandbits(32) << 32 for _ in range(20)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    found = simhash.links(frame("print long", *[(p,) for p in signed]))
    pairs = {frozenset((a % 2**64, b % 2**64)) for a, b in map(tuple, found.collect())}
    ordered = sorted(prints)
    wanted = {
        frozenset((a, b)) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= 2
    }
    assert pairs == wanted


@pytest.mark.parametrize("distance", (1, 3))
def test_other_distances(frame, monkeypatch, distance):
    monkeypatch.setattr(simhash, "BUCKET", 2)
    rng = random.Random(distance)
    prints = sorted({sum(1 << b for b in rng.sample((0, 1, 2, 30, 31, 32, 33, 61, 62), rng.randint(0, 5))) for _ in range(90)})
    found = simhash.links(frame("print long", *[(p,) for p in prints]), distance)
    pairs = {tuple(sorted(r)) for r in found.collect()}
    assert pairs == {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= distance}


def test_keys_stay_small_in_a_large_family(spark):
    """Every fingerprint of a family shares a half; no join key holds more than its neighbourhood."""
    family = spark.range(1 << 13).select(F_low("id"))
    found = simhash.links(family)
    counts = found.groupBy("a").count().agg({"count": "max"}).first()[0]
    # Each of the 13 low bits, alone or in pairs: 13 + 78 neighbours, counted on one side and once per meeting point.
    assert found.distinct().count() == (1 << 13) * (13 + 78) // 2
    assert counts <= 2 * 13 * 14


def F_low(column: str):
    from pyspark.sql import functions as F

    return F.col(column).alias("print")


def test_near_copies_of_odd_rows(odd_documents, monkeypatch):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    prints = [brute_fingerprint(text) for _, text in rows]
    ids = brute_components([key for key, _ in rows], prints)
    # A document without an id is named by another one of its component, or not at all.
    wanted = Counter((key, f"{p:016x}", c) for (key, _), p, c in zip(rows, prints, ids, strict=True))
    for frequent in (1, 1000):
        monkeypatch.setattr(simhash, "FREQUENT", frequent)
        assert Counter(map(tuple, simhash.near_copies(odd_documents).collect())) == wanted
    assert simhash.near_copies(odd_documents.limit(0)).count() == 0


# --- Merkle manifest -------------------------------------------------------------------------


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row) -> str:
    texts = [None if v is None else str(v) for v in row]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def brute_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and every leaf's siblings, each with its side, by whole levels."""
    paths = [[] for _ in leaves]
    places = list(range(len(leaves)))
    while len(leaves) > 1:
        for leaf, place in enumerate(places):
            sibling = place ^ 1
            if sibling < len(leaves):
                paths[leaf].append(("r" if place % 2 == 0 else "l", leaves[sibling]))
            else:
                paths[leaf].append(("n", ""))
        leaves = [digest(*leaves[i : i + 2]) for i in range(0, len(leaves), 2)]
        places = [place // 2 for place in places]
    return leaves[0], paths


def brute_manifest(rows, partition: int) -> Counter:
    """Counter of (key, leaf, path, subroot, root) of rows whose first value is the key."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[partition]].append((row[0] is not None, row[0] or 0, brute_leaf(row), row[0]))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda r: r[:3])
        built[name] = brute_tree([r[2] for r in trees[name]])
    root, tops = brute_tree([built[name][0] for name in names]) if names else ("", [])
    found = Counter()
    for name, top in zip(names, tops, strict=True):
        subroot, paths = built[name]
        for (_, _, leaf, key), path in zip(trees[name], paths, strict=True):
            steps = "".join(side + sibling for side, sibling in [*path, *top])
            found[key, leaf, steps, subroot, root] += 1
    return found


@pytest.mark.parametrize("block", (2, 8, 512))
@pytest.mark.parametrize("trees", (1, 5))
def test_manifest_by_whole_levels(spark, frame, block, trees):
    rng = random.Random(block + trees)
    rows = [(i, rng.choice("xy"), None if t == 0 else f"t{t}", rng.randint(0, 9)) for i in range(77) for t in [rng.randint(0, trees - 1) ** 2 % trees]]
    rows += [(None, "x", "t1", 3), (None, None, "t1", None), (5, "x", "t1", 3), (5, "x", "t1", 3)]
    documents = frame("doc_id long, source string, lang string, n_chars long", *rows).repartition(5)
    found = merkle.manifest(documents, documents.columns, block=block)
    assert Counter(map(tuple, found.select("doc_id", "leaf", "path", "subroot", "root").collect())) == brute_manifest(rows, 2)
    again = merkle.folded(found["leaf"], found["path"])
    assert found.filter(again != found["root"]).count() == 0


def test_witnesses_are_extended_by_later_appends():
    """Aligned appends of subtrees give the witnesses of single appends."""
    leaves = [digest(str(i)) for i in range(11)]
    single = merkle.Witnesses()
    for one in leaves:
        single.append(one)
    blocks = merkle.Witnesses()
    for at in range(0, 11, 4):
        inner = merkle.Witnesses()
        for one in leaves[at : at + 4]:
            inner.append(one)
        blocks.append(inner.close(2), 2)
    assert blocks.close() == single.close() == brute_tree(leaves)[0]
    assert single.paths[0][2:] == blocks.paths[0] and single.paths[10][2:] == blocks.paths[2]
    with pytest.raises(ValueError, match="aligned"):
        open_one = merkle.Witnesses()
        open_one.append(leaves[0])
        open_one.append(leaves[1], 1)


def test_manifest_of_the_table(spark, folder, rows_of):
    rows = rows_of("documents", *merkle.COLUMNS)
    wanted = brute_manifest(rows, 2)
    proofs = {key: digest(*re.findall("[0-9a-f]{64}", path)) for key, _, path, _, _ in wanted}
    ends = {key: (leaf, subroot, root) for key, leaf, _, subroot, root in wanted}
    found = QUERIES["op13_merkle_manifest"](spark, folder).collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.leaf, row.subroot, row.root) == ends[row.doc_id]
        assert row.proof_sha256 == proofs[row.doc_id]
        assert row.verified == (zlib.crc32(str(row.doc_id).encode()) % 7 != 0) == (row.folded_root == row.root)


def test_manifest_of_odd_rows(odd_documents):
    columns = ("doc_id", "text", "source", "size", "label", "family", "key")
    rows = [tuple(r) for r in odd_documents.select(*columns).collect()]
    found = merkle.manifest(odd_documents, columns, partition="source", carry=("key", "shard"))
    got = Counter(map(tuple, found.select("doc_id", "leaf", "path", "subroot", "root").collect()))
    assert got == brute_manifest(rows, 2)
    assert found.filter("key <=> 'k' AND shard <=> 1").count() == len(rows)
    assert merkle.manifest(odd_documents.limit(0), columns, partition="source").count() == 0
