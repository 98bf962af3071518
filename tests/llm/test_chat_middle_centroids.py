"""Chats from logs, moved middles and centroids against brute force, on awkward rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from joinwright.llm import centroids, chat, middle

# ------------------------------------------------------------------------- chats

EVENTS = (
    "conv_id long, message long, seq long, kind string, role string, start long, stop long, text string,"
    " steps string, edge int, PART int"
)
CONTROL = "</s>[INST] ok [/INST]"


def plain_fold(rows):
    """Messages left by a log, event by event."""
    least = lambda v: (v is not None, v if v is not None else 0)
    text_first = lambda v: (v is not None, v or "")
    seen, state = set(), {}
    for conv, message, seq, kind, role, start, stop, text in sorted(
        rows,
        key=lambda r: (
            least(r[0]), least(r[1]), least(r[2]), text_first(r[3]), text_first(r[4]), least(r[5]),
            least(r[6]), text_first(r[7]),
        ),
    ):
        if kind not in chat.KINDS or (conv, message, seq) in seen:
            continue
        seen.add((conv, message, seq))
        at, text = (conv, message), text or ""
        role_, old = state.get(at) or (None, "")
        gone = at in state and state[at] is None
        if kind == "open":
            state[at] = (role, text)
        elif kind == "retract":
            state[at] = None
        elif gone:
            continue
        elif kind == "delta":
            state[at] = (role_, old + text)
        elif kind == "regenerate" or start is None:
            state[at] = (role_, text)
        else:
            low = max(0, start)
            high = max(low, stop if stop is not None else low)
            state[at] = (role_, old[:low] + text + old[high:])
    return {k: v for k, v in state.items() if v is not None}


def random_log(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        conv = rnd.choice([0, 0, 0, 0, 1, 2, None])  # one conversation has most of the rows
        message = rnd.choice([0, 0, 0, 1, 2, 3, None])
        kind = rnd.choice(["open", "delta", "delta", "delta", "edit", "edit", "regenerate", "retract", "seen", None])
        text = rnd.choice(["a", "bc é", CONTROL, "", None, "x" * 300])
        start = rnd.choice([None, 0, 1, 3, 500, -2])
        stop = None if start is None else rnd.choice([None, start, start + 2, 0])
        rows.append((conv, message, seq if seq % 50 else None, kind, rnd.choice(["user", None]), start, stop, text))
        if seq % 7 == 0:
            rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 40), (4, 40)])
def test_logs_are_folded(spark, seed, parts):
    """Many partitions cut the hot conversation, and messages, into stretches."""
    rows = random_log(seed)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], EVENTS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == plain_fold(rows)


def test_stretches_add_up():
    """Cut anywhere, a message's stretches give what all its events give."""
    for seed in range(300):
        rnd = random.Random(seed)
        rows = [r for r in random_log(seed, 12) if r[3] in chat.KINDS]
        steps = [chat.step_of({"kind": r[3], "role": r[4], "start": r[5], "stop": r[6], "text": r[7]}) for r in rows]
        whole = chat.Folded()
        for s in steps:
            whole.add(s)
        pieces, at = chat.Folded(), 0
        while at < len(steps):
            cut, stop = chat.Folded(), rnd.randint(at + 1, len(steps))
            for s in steps[at:stop]:
                cut.add(s)
            for s in cut.done():
                pieces.add(s)
            at = stop
        assert pieces.message() == whole.message(), seed
        plain = plain_fold([(0, 0, n, *r[3:]) for n, r in enumerate(rows)])
        assert whole.message() == (plain.get((0, 0)) if rows else (None, "")), seed


def test_marks_in_texts_come_back():
    escapes, rnd = chat.TEMPLATE.escapes(), random.Random(5)
    bits = [*chat.TEMPLATE.controls(), "[", "]", "<", ">", "\\", "/", "s", "INST", " ", "\n", "[\\INST]", "é"]
    for _ in range(3000):
        turns = [
            (rnd.choice(["user", "assistant", "system", "tool", "", "[END]", "[\\END]"]), "".join(rnd.choices(bits, k=rnd.randint(0, 8))))
            for _ in range(rnd.randint(1, 4))
        ]
        made = [chat.rendered(role, text, chat.TEMPLATE, escapes) for role, text in turns]
        assert list(chat.turns_of("".join(m[0] for m in made), chat.TEMPLATE, escapes)) == turns
        for (formatted, start, stop), (_, text) in zip(made, turns, strict=True):
            assert chat.unescaped(formatted[start:stop], escapes) == text


def test_rows_become_logs_become_chats(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None]), rnd.choice([CONTROL, "", None, "long é " * 400, f"text {c} {t}"])) for c in range(20) for t in range(rnd.randint(1, 6))]
    rows += [(99, t, "assistant", f"hot {t}") for t in range(600)] + [(None, 0, "user", "no id"), (7, None, "user", "no turn")]
    rows += [(98, 0, "assistant", "twice")] * 2 + [(97, 1, "assistant", "b"), (97, 1, "user", "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, MESSAGE int")
    log = chat.log_of(df)
    assert {"open", "delta", "edit", "regenerate", "retract"} == {r.kind for r in log.select("kind").distinct().collect()}
    found = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(log))).collect()}
    escapes = chat.TEMPLATE.escapes()
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        said = [t for r, t in turns if r == "assistant"]
        got = found.pop(conv)
        assert got.n_turns == len(turns), conv
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), conv
        assert (got.loss_chars, got.loss_sha256) == (len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())
        assert got.formatted_chars == sum(len(chat.rendered(r, t, chat.TEMPLATE, escapes)[0]) for r, t in turns)
    assert not found


def test_nothing_was_said(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.render(chat.fold(chat.log_of(turns)))).collect() == []


# ------------------------------------------------------------------------ middles

TEXTS = ["", "a", "é", "\U0001f642 x é" * 3, "has <P> inside", "<M>", "<S", "<<P", ">", "plain text " * 50, "é" * 200_000, "x" * 300_000]


def brute(doc_id, text, seed=1):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, a, b - a, output


def test_middles_move_and_come_back(spark):
    rows = [(i * 100 + j, t) for i, t in enumerate(TEXTS) for j in range(12 if len(t) < 1000 else 2)]
    rows += [(None, "no id here"), (5, None), (205, TEXTS[2]), (205, TEXTS[2])]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, n int, form string, OUTPUT string")
    moved = middle.fill_in_middle(df)
    found = sorted((repr(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in moved.collect())
    key = lambda r: (r[0], r[5])
    assert sorted(found, key=key) == sorted(((repr(i), *brute(i, t or "")) for i, t in rows), key=key)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    back = middle.restored(moved)
    assert sorted((repr(r.doc_id), r.text) for r in back.collect()) == sorted((repr(i), t or "") for i, t in rows)
    assert middle.fill_in_middle(df.limit(0)).collect() == [] == middle.restored(moved.limit(0)).collect()


def test_blocks_change_places(monkeypatch):
    for block in (1, 2, 3, 1 << 16):
        monkeypatch.setattr(middle, "BLOCK", block)
        for n in range(12):
            for a in range(n + 1):
                for m in range(a, n + 1):
                    view = np.arange(n, dtype=np.uint8)
                    middle.rotate(view, a, m, n)
                    assert view.tolist() == [*range(a), *range(m, n), *range(a, m)]
        text = "a\U0001f642é b"
        view = np.frombuffer(text.encode(), np.uint8)
        assert [middle.byte_of(view, k, len(text)) for k in range(len(text) + 1)] == [len(text[:k].encode()) for k in range(len(text) + 1)]


# ---------------------------------------------------------------------- centroids

VECTORS = "vec_id long, embedding array<double>, cluster int, Distance int, vector string, n int"


def whole(v, scale=256):
    return [int(x) * scale if abs(x) >= 2**52 else math.floor(scale * x) for x in v]


def plain_clusters(rows, k, rounds, width, seed=2):
    kept = [(i, whole(v)) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centre = [list(v) for _, v in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centre)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centre)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == n]
            if own:
                centre[n] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    inertia = {n: sum(d for d, c in at if c == n) for _, n in at}
    long = lambda x: x if x < 1 << 63 else None
    hashed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    # The total is null as soon as one distance is, as it is then no long either.
    total = sum(inertia.values())
    return [
        (repr(i), c, long(d), long(inertia[c]), long(total), hashed[c]) for (i, _), (d, c) in zip(kept, at)
    ]


def clustered(seed, large=()):
    rnd = np.random.default_rng(seed)
    rows = []
    for c in range(5):
        centre = rnd.normal(size=6) * 2
        rows += [(len(rows) + i, (centre + rnd.normal(size=6) * 0.3).tolist()) for i in range(30)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])] * 3 + [(None, rows[5][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 5 + [None]), (2004, [math.nan] * 6), (2005, [math.inf] * 6)]
    # The same mean and deviation in another order: no bound tells them apart.
    rows += [(3000 + i, rnd.permutation([0.5, 1.0, 1.5, -2.0, 0.0, 3.0]).tolist()) for i in range(30)]
    return rows + [(4000 + i, v) for i, v in enumerate(large)]


@pytest.mark.parametrize("seed,k,large", [
    (1, 9, []), (2, 1, []), (3, 1000, []), (4, 9, [[1e4] * 6, [2.0**40, 1, 2, 3, 4, 5]]),
    (5, 30, [[1e18] * 6, [3e30, 0, 0, 0, 0, 0], [-1e300] * 6, [1.7e308] * 6, [-3e30] * 6]),
])
def test_clusters(spark, monkeypatch, seed, k, large):
    monkeypatch.setattr(centroids, "ROWS", 16)
    rows = clustered(seed, [[float(x) for x in v] for v in large])
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], VECTORS).repartition(5)
    found = centroids.cluster_vectors(df, k=k, rounds=3, width=6).collect()
    want = plain_clusters(rows, k, 3, 6)
    key = lambda r: tuple(map(repr, r))
    assert sorted(((repr(r[0]), *r[1:]) for r in found), key=key) == sorted(want, key=key)


def test_no_vector_no_cluster(spark):
    df = spark.createDataFrame([(1, [1.0], 1, 1, "x", 1), (2, None, 1, 1, "x", 1)], VECTORS)
    for part in (df, df.limit(0)):
        found = centroids.cluster_vectors(part, width=6)
        assert found.collect() == []
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_leave_work_out_and_no_centroid():
    """Distances measured fall far below all, and what is found is what all distances give."""
    rnd = np.random.default_rng(7)
    centre = rnd.integers(-300, 300, size=(40, 1)) + rnd.integers(-60, 60, size=(40, 64))
    x = centre[rnd.integers(0, 40, 5000)] + rnd.integers(-20, 20, size=(5000, 64))
    distance, number, measured = centroids.Centroids(centre.tolist()).nearest(x)
    every = ((x[:, None, :] - centre[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 0.2 * every.size
