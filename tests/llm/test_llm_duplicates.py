"""Near-duplicate documents and vectors, and repeated lines, against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import cones, lines, scan, setsketch
from tidemark.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lower(text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 3 else zip(w, w[1:], w[2:]))


def reachable(ids, links):
    up = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(up[a], up[b])
            changed |= up[a] != low or up[b] != low
            up[a] = up[b] = low
    return up


def edited(rng, text, share):
    words = text.split(" ")
    for k in range(len(words)):
        if rng.random() < share:
            words[k] = rng.choice(["new", "other", "words"]) + str(rng.randint(0, 99))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    out = []
    for family in range(6):
        base = prose(100 + family, rng.choice([40, 120, 400]))
        out += [edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.2])) for _ in range(25)]
    out += ["alpha", "Alpha", "alpha beta", "alpha  beta", "gamma", "", None, " "]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("group_rows", [400, 7])
def test_near_duplicates_equal_brute_force(texts_of, corpus, group_rows):
    """With groups of 7 the hubs are dealt into many, so links across groups matter."""
    sets = dict(enumerate(map(shingles, corpus)))
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = reachable(sets, links)
    got = setsketch.near_duplicates(texts_of(corpus), group_rows=group_rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()
    }
    assert len(links) > 200


def wide_shingles(text, width):
    w = WORD.findall(lower(text or ""))
    if 0 < len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(zip(*(w[k:] for k in range(width))))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_width_and_threshold_of_near_duplicates(texts_of, corpus, width, percent):
    """A tail of 85 words leaves 0.82 in common in either width; ten words changed in
    400 leave 0.86 of three-word shingles and 0.78 of five-word ones."""
    words = [f"w{k}" for k in range(400)]
    tail = words + [f"tail{k}" for k in range(85)]
    scattered = [f"new{k}" if k % 40 == 20 else w for k, w in enumerate(words)]
    texts = [" ".join(words), " ".join(tail), " ".join(scattered), "a b c d", *corpus]
    sets = {i: wide_shingles(text, width) for i, text in enumerate(texts)}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = reachable(sets, links)
    assert (want[1] == 0, want[2] == 0) == ((False, True) if width == 3 else (True, False))
    got = setsketch.near_duplicates(texts_of(texts), percent, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
        i: (len(s), want[i]) for i, s in sets.items()
    }


@pytest.mark.parametrize("percent", [50, 80, 85, 90])
def test_bands_miss_few_pairs_at_the_threshold(percent):
    band = setsketch.band_of(percent)
    missed = (1 - (percent / 100) ** band) ** (setsketch.REGISTERS // band)
    assert missed <= 3e-7


def test_near_duplicates_of_odd_rows(odd):
    got = setsketch.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[2][0].component_id == 1 and not by[2][0].kept
    assert by[10][0].component_id == 7  # ONE and one
    assert [r.n_shingles for r in by[4] + by[5] + by[6]] == [0, 0, 0]
    assert all(r.component_id == 9 for r in by[9]) and len(by[9]) == 3
    assert all(r.component_id is None for r in by[None])


def test_texts_of_one_id_share_its_links(spark):
    a, b = prose(1, 200), prose(2, 200)
    rows = [(5, a), (5, b), (6, a + " more"), (7, b + " more"), (8, prose(3, 200)), (5, a)]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter((r.doc_id, r.component_id) for r in got.collect()) == Counter(
        {(5, 5): 3, (6, 5): 1, (7, 5): 1, (8, 8): 1}
    )


def test_near_duplicates_of_nothing(odd):
    assert setsketch.near_duplicates(odd.limit(0)).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2600]
    both = np.union1d(a, b)
    one, two, union = setsketch.registers_of([np.sort(a), np.sort(b), both])
    assert (setsketch.merge(one, two) == union).all()
    truth = len(np.intersect1d(a, b)) / len(both)
    found = setsketch.likely_similarity(one, len(a), two[None, :], np.array([len(b)]))[0]
    assert abs(found - truth) < 0.12
    tiny, empty = setsketch.registers_of([pool[:1], pool[:0]])
    assert (empty == setsketch.LOWEST).all() and (tiny > setsketch.LOWEST).all()
    same = setsketch.registers_of([pool[:1]])[0]
    assert (same == tiny).all()


def test_components_of_long_chains_and_odd_links(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    links = chain + [(5, 5), (None, 3), (9, 7), (7, 9), (7, 8)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = {i: 100 for i in range(100, 181)} | {7: 7, 8: 7, 9: 7}
    assert {r.id: r.component_id for r in got} == want and len(got) == len(want)


def test_word_hashes_tell_words_apart():
    texts = ["a b", "ab", "ä b", "a  b\n", "", "b a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    block = scan.Block(data, offsets)
    assert block.n_words.tolist() == [2, 1, 2, 2, 0, 2]
    a, b, ab, ae, b2, a2, b3, b4, a3 = block.words().tolist()
    assert a == a2 == a3 and b == b2 == b3 == b4 and len({a, b, ab, ae}) == 4


# --------------------------------------------------------------------- vectors


def vector_rows(seed=4, dim=24):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(60):
        x = rng.standard_normal(dim)
        out.append(x)
        for _ in range(rng.integers(0, 6)):
            noise = rng.standard_normal(dim)
            noise -= (noise @ x) / (x @ x) * x
            c = rng.uniform(0.85, 1.0)
            y = c * x / np.linalg.norm(x) + np.sqrt(1 - c * c) * noise / np.linalg.norm(noise)
            out.append(y * rng.uniform(0.1, 9))
    out += [out[0]] * 5 + [out[3] * 2]
    return [x.tolist() for x in out]


@pytest.mark.parametrize("slice_rows", [512, 5])
def test_vectors_equal_brute_force(spark, slice_rows):
    rows = vector_rows()
    x = np.array(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b]
    want = reachable(range(len(rows)), links)
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>")
    got = cones.near_vectors(df, slice_rows=slice_rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (int(near[i].sum()), want[i], want[i] == i) for i in range(len(rows))
    }


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0),
        (2, [2.0, 0.0], None),
        (3, None, 1),
        (4, [], 1),
        (5, [0.0, 0.0], 1),
        (6, [1.0, None], 1),
        (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1),
        (9, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1),
        (10, [1.0, 0.0], 1),
        (10, [0.0, 1.0], 1),
        (11, [1e-30, 0.0], 1),
    ]
    schema = "vec_id bigint, embedding array<float>, label int"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema + ", class string, n int, filter string")
    got = sorted(cones.near_vectors(df).collect(), key=str)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] and by[11] == [(3, 1, False)]
    for k in (3, 4, 5, 6, 7, 8, 9):
        assert by[k] == [(0, k, True)]
    assert by[None] == [(0, None, True)] and len(by[10]) == 2
    assert cones.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("grid, slice_rows", [(cones.GRID, 512), (0.004, 512), (0.004, 7), (0.02, 512)])
def test_cells_with_different_vectors_are_settled_exactly(spark, grid, slice_rows):
    """Coarse cells hold vectors that link with some of their neighbours and not with others."""
    rng = np.random.default_rng(12)
    rows = []
    for _ in range(12):
        x, e = rng.standard_normal((2, 16))
        x /= np.linalg.norm(x)
        e -= (e @ x) * x
        e /= np.linalg.norm(e)
        for c in (1.0, 0.9 + 1e-7, 0.9 - 1e-7, 0.9001, 0.95):
            y = c * x + np.sqrt(1 - c * c) * e
            # scaled copies, and copies moved by less than a coarse cell
            rows += [y * k for k in (1, 3, 0.7)] + [y + rng.standard_normal(16) * 3e-4 for _ in range(3)]
    x = np.array(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b]
    want = reachable(range(len(rows)), links)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    got = cones.near_vectors(df, slice_rows=slice_rows, grid=grid).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {
        i: (int(near[i].sum()), want[i]) for i in range(len(rows))
    }


def test_scaled_copies_are_few_classes(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(64)
    rows = [(i, (base * s).tolist()) for i, s in enumerate(rng.uniform(0.001, 900, 3000))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert df.select(cones.cell("embedding")).distinct().count() < 20
    got = cones.near_vectors(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(2999, 0)}
    extreme = spark.createDataFrame([(1, [1e-300, 2e-300]), (2, [1e300, 2e300]), (3, [-1.0, -2.0])], "vec_id bigint, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in cones.near_vectors(extreme).collect()) == [
        (1, 1, 1), (2, 1, 1), (3, 0, 3)
    ]


def test_filters_are_those_above_the_cap():
    rng = np.random.default_rng(5)
    code = cones.Code(12, 3, 6)
    x = rng.standard_normal((40, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, filt = code.filters(x, 0.3)
    found = Counter(zip(row.tolist(), filt.tolist()))
    assert set(found.values()) == {1}
    turned = x @ code.turn
    for f in range(6**3):
        words = f // 36, f // 6 % 6, f % 6
        direction = np.concatenate([b[w] for b, w in zip(code.books, words)]) / np.sqrt(3)
        assert {r for r, g in found if g == f} == set(np.flatnonzero(turned @ direction >= 0.3))


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold share a filter nearly always."""
    rng = np.random.default_rng(6)
    dim, n = 64, 50_000
    parts, words, cap = cones.plan(n, dim)
    a = rng.standard_normal((500, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    e = rng.standard_normal(a.shape)
    e -= (e * a).sum(axis=1, keepdims=True) * a
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    b = 0.9001 * a + np.sqrt(1 - 0.9001**2) * e
    met = np.zeros(len(a), bool)
    for k in range(cones.CODES):
        code = cones.Code(dim, parts, words, cones.SEED + k)
        one, two = (set(zip(*map(np.ndarray.tolist, code.filters(x, cap)))) for x in (a, b))
        met[[r for r, _ in one & two]] = True
    assert met.mean() >= 0.99


@pytest.mark.parametrize("n", [1_000_000, 100_000_000])
def test_recall_at_the_threshold_of_large_tables(n):
    """As many codes as the plan of n vectors needs."""
    parts, words, cap = cones.plan(n, 64)
    codes = cones.codes_of(64, parts, words, cap, cones.THRESHOLD, cones.CODES, cones.RECALL)
    a, b = cones.pairs_at(0.9001, 64, 1000, 6)
    missed = np.ones(len(a), bool)
    for code in codes:
        missed[missed] = ~cones.met(code, cap, a[missed], b[missed])
    assert missed.mean() <= 0.004
    assert len(codes) >= cones.CODES


# ----------------------------------------------------------------------- lines


def without_repeats(docs, width=3):
    found, parts = defaultdict(list), {}
    for i, text in docs:
        parts[i] = (text or "").split("\n")
        full = [(k, x.strip(" \t\v\f\r")) for k, x in enumerate(parts[i]) if x.strip(" \t\v\f\r")]
        for k in range(len(full) - width + 1):
            key = tuple(x for _, x in full[k : k + width])
            found[key].append((i, full[k][0], full[k + width - 1][0]))
    gone = defaultdict(set)
    for places in found.values():
        for i, low, high in sorted(places)[1:]:
            gone[i] |= set(range(low, high + 1))
    return {
        i: (len(gone[i]), "\n".join(x for k, x in enumerate(p) if k not in gone[i]))
        for i, p in parts.items()
    }


def test_repeated_lines_equal_brute_force(texts_of):
    rng = random.Random(2)
    some = ["red", "green ", "blue", "", " \t", "sky", "a", "b"]
    texts = ["\n".join(rng.choices(some, k=rng.randint(0, 14))) for _ in range(300)]
    got = lines.remove_repeated_lines(texts_of(texts)).collect()
    want = without_repeats(enumerate(texts))
    assert {r.doc_id: (r.n_lines_removed, r.text) for r in got} == want
    assert sum(n for n, _ in want.values()) > 500


def test_repeated_lines_of_odd_rows(odd):
    got = lines.remove_repeated_lines(odd)
    assert sorted(got.columns) == sorted(odd.columns)
    rows = got.collect()
    assert len(rows) == odd.count()
    by = {(r.doc_id, r.text is None): r for r in rows}
    assert by[None, True].n_lines_removed == 0
    hidden = ["_mark", "_doc", "_gone", "_mark_of", "_done", "mark", "gone"]
    assert {tuple(r[c] for c in hidden) for r in rows} == {(1, 2, 3, 4, 5, 6, "y")}
    # the null id comes first, so 1 and 2 lose their copies of its text
    assert by[1, False].text == "" and by[2, False].text == "" and by[None, False].text
    # a window that begins on the first one's second line is a later one too
    assert by[12, False].text == "same line here"
    assert lines.remove_repeated_lines(odd.limit(0)).collect() == []
