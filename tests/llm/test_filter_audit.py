import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from cellindex.llm.filter_audit import Diagram, all_steps, audit, audit_texts, failure_masks, neighbour_swaps, text_rules


def plain_steps(n, counts, orders):
    """Every mask through every order, one filter after another."""
    rows, total = [], Counter()
    for order in orders:
        left = dict(counts)
        for k, f in enumerate(order):
            gone = [m for m in left if m >> f & 1]
            out = [sum(left[m][i] for m in gone) for i in range(3)]
            fails = sum(c[0] for m, c in counts.items() if m >> f & 1)
            for m in gone:
                del left[m]
            total[f] += out[0]
            alone = counts.get(1 << f, (0,))[0]
            rows.append((tuple(order), k + 1, f, sum(c[0] for c in left.values()), out[0], fails - out[0], alone, out[1], out[2]))
    return sorted((*r, total[r[2]]) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_diagrams_against_masks(n):
    draw = random.Random(n)
    for share in (0.0, 0.2, 0.7, 1.0):
        counts = {m: (draw.randint(1, 9), draw.randint(0, 3), draw.randint(0, 1)) for m in range(1 << n) if draw.random() < share}
        assert sorted(all_steps(n, counts)) == plain_steps(n, counts, permutations(range(n)))


def test_given_orders():
    counts = {m: (m % 3, m % 2, 0) for m in range(64)}
    orders = [[3, 1, 5, 0, 2, 4], [0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0]]
    assert sorted(all_steps(6, counts, orders)) == plain_steps(6, counts, orders)


def test_swaps_run_through_all_orders():
    for n in range(1, 7):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for k in neighbour_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.add(tuple(order))
        assert len(seen) == factorial(n) == 1 + sum(1 for _ in neighbour_swaps(n))


def test_equal_remainders_are_one_node():
    diagram = Diagram(10, {m: (1, 0, 0) for m in range(1 << 10)})
    assert diagram.size() == 11
    diagram.reorder(list(reversed(range(10))))
    assert diagram.size() == 11 and diagram.order == list(reversed(range(10)))


def plain_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (len(words) < 100)
        + 2 * (100 * len(set(words)) < 80 * len(words))
        + 4 * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        + 8 * bool(re.search(r"[#$%&*|]", text))
    )


TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "UPPER lower", "ABC \U0001f600\U0001f600\U0001f600 Éx", "a|b", "x " * 100, "x " * 99,
    " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i % 80}" for i in range(100)), " ".join(f"W{i % 79}" for i in range(100)),
    " ".join(f"w{i}" for i in range(100)) + " #", "one word here", "w\x00 \x1f v", "long " + "z" * 200_000,
]


@pytest.fixture(scope="module")
def some(spark):
    draw = random.Random(1)
    rows = [(draw.choice([None, *range(40)]), draw.choice(TEXTS), draw.choice(["en", "", None, "de"]), 1, "x") for _ in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, part int, mask string")
    marks = [(draw.randint(0, 60), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    return rows, docs, marks, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_rows_against_plain(some):
    rows, docs, marks, labels = some
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({d for d, *m in marks if d is not None and m[i] == 1} for i in (0, 1))
    counts = {}
    for d, t, part, *_ in rows:
        mask = plain_mask(t or "") + 16 * (d is not None and d > least[t or ""])
        c = counts.setdefault(part or "", {}).setdefault(mask, [0, 0, 0])
        c[0] += 1
        c[1] += d in good
        c[2] += d in toxic
    expected = set()
    for part, masks in counts.items():
        masks = {m: tuple(c) for m, c in masks.items()}
        for order, k, _, *rest in plain_steps(5, masks, permutations(range(5))):
            expected.add((part, "".join("ABCDE"[f] for f in order), k, *rest))
    got = [tuple(r) for r in audit_texts(docs, labels).collect()]
    assert set(got) == expected and len(got) == len(expected) == 3 * 600


def test_without_repeats_and_with_other_filters(some):
    _, docs, _, labels = some
    rules = {"short": F.length("text") < 5, "none": F.col("text").isNull()}
    masks = failure_masks(docs, labels, rules)
    rows = audit(masks, list(rules), [["none", "short"]]).collect()
    assert {r.filter_order for r in rows} == {"noneshort"}
    nulls = docs.filter("text IS NULL").count()
    assert sum(r.removed for r in rows if r.step == 1) == nulls
    assert sum(r.kept for r in rows if r.step == 2) == docs.filter("length(text) >= 5").count()


def test_empty_and_wrong(spark, no_docs, some):
    assert audit_texts(no_docs, some[3]).collect() == []
    masks = spark.createDataFrame([], "part string, mask int, n long, good long, toxic long")
    for names, orders in ((list("ABCDEFGH"), None), (list("AB"), [["A"]])):
        with pytest.raises(ValueError):
            audit(masks, names, orders)
    with pytest.raises(ValueError):
        failure_masks(no_docs, some[3], {str(k): F.lit(True) for k in range(17)})
    assert list(text_rules()) == list("ABCDE")
