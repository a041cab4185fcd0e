import numpy as np
import xxhash

from questlog.llm import simhash
from questlog.llm.graph import components


def plain_fingerprint(text: str, k: int = 4) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids: list, prints: list[int], distance: int = 4) -> list:
    group = list(range(len(ids)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[find(i)] = find(j)
    least: dict = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprint_of_any_text(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    for text in ["", " \t", "One", "a b c", "A b C d", "É x É x É x É x É", "w " * 5000, "a\x0bb\x0cc\xa0d e f g " * 9]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text), text


def test_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toPandas().itertuples(index=False)]
    base = rows[3][1]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "only here, nowhere else at all"), (5003, base), (5003, base), (None, base + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS id", "3 AS component_id", "4 AS shard")
    got = simhash.near_duplicates(docs).toPandas()
    prints = [plain_fingerprint(t or "") for _, t in rows]
    wanted = plain_components([i for i, _ in rows], prints)
    show = lambda xs: sorted((str(a), b, str(c)) for a, b, c in xs)
    none = lambda v: None if v is None or v != v else int(v)
    assert show((none(a), b, none(c)) for a, b, c in got[["doc_id", "fingerprint", "component_id"]].itertuples(index=False)) == show(
        (i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, wanted)
    )


def test_trees_find_every_pair(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(simhash, "SHARD_POINTS", 40)
    monkeypatch.setattr(simhash, "SHARD_LIMIT", 60)
    centre = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (60, 15, 2), dtype=np.uint64)
    near = centre[:, None] ^ flips[..., 0] ^ flips[..., 1]
    dense = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 20, (300, 5), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    values = np.unique(np.concatenate([near.ravel(), dense]))
    for distance in (0, 1, 4):
        fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
        roots = {r["node"]: r["root"] for r in components(simhash.links(fps, distance)).collect()}
        named = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
        plain = plain_components(list(range(len(values))), [int(v) for v in values], distance)
        pairs = set(zip(named, plain))
        assert len(pairs) == len(set(named)) == len(set(plain))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0


def test_components_of_a_chain_loops_and_repeats(spark):
    links = [(i, i + 1) for i in range(200)] + [(7, 7), (500, 501), (501, 500), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r["root"] for r in found if r["node"] <= 200}) == 1
    assert len({r["root"] for r in found}) == 2 and len(found) == 203
