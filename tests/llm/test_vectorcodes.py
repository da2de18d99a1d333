import hashlib

import numpy as np
import pytest

from oreflow.llm import vectorcodes as vc


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: vec_id, vector, label.  Plain Python integers, every distance computed."""
    kept = [(i, [int(np.floor(256 * np.float64(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((x for x in kept if x[0] is not None), key=lambda x: (x[0], np.array(x[1], "<i4").tobytes()))
    length = len(named[0][1]) if named else 0
    usable = bool(named) and length % parts == 0
    fit = [x for x in kept if usable and len(x[1]) == length]
    size = length // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    seeds = [x for x in named if len(x[1]) == length][:entries] if usable else []
    books = [[cut(s[1], p) for s in seeds] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in fit:
                groups.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            for e, members in groups.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out, totals = [], {}
    for i, v, label in kept:
        found = [nearest(v, p) for p in range(parts)] if seeds and len(v) == length else None
        error = sum(d for d, _ in found) if found else None
        totals[label] = totals.get(label, 0) + (error or 0)
        out.append((i, "".join(f"{e:02x}" for _, e in found) if found else None, error, label))
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest() if seeds else None
    return sorted(((i, c, e, totals[label], digest) for i, c, e, label in out), key=str)


def some_rows(n=700, dims=32, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, dims))
    near = [(int(i), (centers[i % 9] + 0.2 * rng.normal(size=dims)).astype(np.float32).tolist(), int(i % 4)) for i in rng.permutation(n)]
    return near + [(None, near[0][1], None), (None, near[1][1], None), (3, near[5][1], 1), (3, near[6][1], None), (7000, near[7][1], 2),
                   (7001, near[7][1], 2), (8000, None, 1), (8001, [None] * dims, 1), (8002, [float("nan")] * dims, 1),
                   (8003, [float("-inf")] + [0.0] * (dims - 1), 1), (8004, [], 5), (8005, [1.0] * (dims + 16), 5), (8006, [0.5], 6)]


DDL = "vec_id long, embedding array<float>, label int, vector string, code string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*x, "a", "b", "c") for x in rows], DDL)


def codes(found):
    return sorted(map(tuple, found.collect()), key=str)


def test_codes_are_brute_force(spark):
    rows = some_rows()
    assert codes(vc.vector_codes(frame(spark, rows).repartition(5))) == brute(rows)


@pytest.mark.parametrize("rows", [
    some_rows(40, 16),  # fewer vectors than entries
    [(1, [0.25] * 16, None), (2, [0.25] * 16, None), (3, [-0.25] * 16, None)],  # ties
    [(1, [0.5] * 15, 1), (2, [0.5] * 16, 1)],  # not to be cut into parts
    [(None, [0.5] * 16, 1)], [(1, [], 1), (2, [1.0], 1)], [(1, None, 1)],
])
def test_codes_of_odd_tables(spark, rows):
    assert codes(vc.vector_codes(frame(spark, rows))) == brute(rows)


def test_codes_of_an_empty_table(spark):
    assert vc.vector_codes(frame(spark, [])).count() == 0


def test_large_components_are_exact_or_refused(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (250_000 * rng.uniform(-1, 1, 16)).tolist(), 0) for i in range(90)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    assert codes(vc.vector_codes(frame(spark, rows))) == brute(rows)
    with pytest.raises(Exception, match="2\\^26"):
        vc.vector_codes(frame(spark, [(1, [3e5] * 16, 0)])).count()


@pytest.mark.parametrize("groups", [1, 3, 8, 64])
def test_bounds_change_no_code_and_spare_scans(groups):
    rng = np.random.default_rng(groups)
    vectors = (256 * (rng.normal(size=(12, 32))[rng.integers(0, 12, 3000)] + 0.3 * rng.normal(size=(3000, 32)))).astype(np.int64)
    book = vectors[:64].reshape(64, 4, 8).transpose(1, 0, 2).copy()
    some = vc.near_groups(book, groups)
    assert all(len(x) == groups and sorted(np.concatenate(x).tolist()) == list(range(64)) for x in some)
    history, state, scans = [book], None, []
    for _ in range(7):
        state = vc.assign(vectors, history, some, state)
        full = vc.assign(vectors, [history[-1]], some, None)
        assert (state.code == full.code).all() and (state.error == full.error).all()
        scans.append(state.scanned)
        for part in range(4):  # every bound holds, at the time of its stamp and of now
            x = vectors[:, part * 8 : part * 8 + 8]
            far = np.sqrt(((x[:, None, :] - history[-1][part][None]) ** 2).sum(axis=2))
            far[np.arange(len(x)), state.code[:, part]] = np.inf
            moved = vc.displacements(history, some)
            for i, group in enumerate(some[part]):
                low = state.low[:, part, i].astype(float) - moved[state.stamp[:, part, i], part, i]
                assert (low <= far[:, group].min(axis=1)).all()
        following = history[-1].copy()
        for part in range(4):
            for entry in np.unique(state.code[:, part]):
                following[part, entry] = vectors[state.code[:, part] == entry, part * 8 : part * 8 + 8].sum(axis=0) // (state.code[:, part] == entry).sum()
        history.append(following)
    assert scans[-1] < (0.7 if groups == 1 else 0.6) * scans[0]


def test_net_displacement_is_at_most_the_steps():
    rng = np.random.default_rng(1)
    history = list(np.cumsum(rng.integers(-9, 9, size=(5, 2, 8, 3)), axis=0))
    groups = [[np.arange(4), np.arange(4, 8)]] * 2
    net = vc.displacements(history, groups)
    steps = sum(vc.displacements(history[i : i + 2], groups)[0] for i in range(4))
    assert (net[0] <= steps * vc._SLACK).all() and (net[0] < 0.9 * steps).any() and (net[-1] == 0).all()


def test_codes_restore_vectors_about(spark):
    rows = [x for x in some_rows() if x[0] is not None and x[0] < 700]
    found = vc.compressed(frame(spark, rows))
    near = {x["vec_id"]: x["vector"] for x in vc.restored(found.rows, found.books[-1]).collect()}
    error = np.mean([np.mean((np.array(near[i]) - np.array(v)) ** 2) for i, v, _ in rows[:200] if i != 3])
    assert error < 0.2 * np.mean([np.var(v) for _, v, _ in rows[:200]])
