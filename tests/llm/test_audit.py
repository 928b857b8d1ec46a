import itertools
import re

from helixframe.llm import audit

from .helpers import documents, empty, texts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Every row of the result, each order walked by itself."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = []
    for i, t, source in docs:
        t = t or ""
        w = WORDS.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t]}
        mine = [x for x in labels if x[0] == i and i is not None]
        rows.append((source or "", {k for k, v in fails.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        walks = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                kept = [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                walks.append([part, "".join(order), step, len(kept), len(lost), len(failing) - len(lost), sum(r[1] == {f} for r in own), sum(r[2] for r in lost), sum(r[3] for r in lost)])
                left = kept
        total = {f: sum(w[4] for w in walks if w[1][w[2] - 1] == f) for f in "ABCDE"}
        out += [(*w, total[w[1][w[2] - 1]]) for w in walks]
    return sorted(out)


LABELS = "doc_id long, quality int, toxic int, mask string, id string"


def test_against_brute_force(spark):
    loud = ["SHOUT " * 250, "# " + "w" * 400, "a $ b", "same same " * 150, " ".join(f"w{i}" for i in range(300)), "x" * 100_000]
    docs = documents(spark, texts(n=12) + loud + loud)
    labels = [(i, i % 2, i % 3 // 2) for i in range(0, 40, 3)] + [(3, 1, 1), (3, None, None), (None, 1, 1), (999, 1, 1)]
    frame = spark.createDataFrame([(*x, "m", "i") for x in labels], LABELS)
    got = sorted(map(tuple, audit.filter_audit(docs, frame).collect()))
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()], labels)
    assert got == want
    assert len(got) == 600 * len({r[0] for r in got}) and sum(r[4] for r in got) > 0


def test_empty_tables(spark):
    no_labels = spark.createDataFrame([], LABELS)
    assert audit.filter_audit(empty(spark), no_labels).count() == 0
    assert audit.filter_audit(documents(spark, ["one", "two"]), no_labels).where("removed > 0").count() > 0


def test_one_swap_at_a_time():
    for n in range(1, 6):
        walk = list(audit.transpositions(n))
        assert len({tuple(o) for o, _ in walk}) == len(walk) == len(list(itertools.permutations(range(n))))
        for (before, _), (after, at) in itertools.pairwise(walk):
            swapped = list(before)
            swapped[at], swapped[at + 1] = swapped[at + 1], swapped[at]
            assert swapped == after
