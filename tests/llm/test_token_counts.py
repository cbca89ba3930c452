from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from cellindex.llm.token_counts import RULES, allot, count_tokens, line_sections  # noqa: E402
from cellindex.llm.tokens import public_path  # noqa: E402

PATH = public_path("byte_bpe_50k.json")


def by_character(start, end, sections, rule):
    """Every token's characters one by one."""
    counts = Counter()
    for s, e in zip(start, end):
        where = [next((k for k, (a, b) in enumerate(sections) if a <= c < b), -1) for c in range(s, e)] or [-1]
        if rule == "start":
            counts[where[0]] += 1
        elif rule == "end":
            counts[where[-1]] += 1
        elif rule == "share":
            for w in where:
                counts[w] += 1 / len(where)
        else:
            most = max(Counter(where).values())
            best = [w for w, n in Counter(where).items() if n == most]
            counts[min(best, key=lambda w: (w == -1, w))] += 1
    return counts


@pytest.mark.parametrize("rule", RULES)
def test_rules_against_single_characters(rule):
    draw = np.random.default_rng(3)
    for _ in range(60):
        cuts = np.sort(draw.choice(60, 6, replace=False))
        sections = [(cuts[0], cuts[1]), (cuts[1], cuts[2]), (cuts[3], cuts[4])]
        edges = np.concatenate([[0], np.sort(draw.choice(np.arange(1, 60), 12, replace=False)), [60]])
        got = allot(edges[:-1], edges[1:], *(np.array(x) for x in zip(*sections)), rule)
        want = by_character(edges[:-1], edges[1:], sections, rule)
        assert np.allclose(got, [*[want[k] for k in range(3)], want[-1]])


def test_lines_of_documents(spark, odd_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    rows = count_tokens(odd_docs, PATH, rule="majority").collect()
    want = []
    for r in odd_docs.collect():
        text = r.text or ""
        spans = library.encode(text, add_special_tokens=False).offsets
        sections = list(zip(*(x.tolist() for x in line_sections(text)))) if text else []
        found = by_character(*zip(*spans), sections, "majority") if spans else {}
        want += [(r.doc_id, k, a, b, float(found.get(k, 0)), len(spans)) for k, (a, b) in enumerate(sections)]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_given_sections_and_gaps(spark):
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma", [(0, 7), (7, 12)]), (2, "alpha", None), (3, None, []), (4, "a b", [(0, 9)])],
        "doc_id int, text string, parts array<struct<first:int,end:int>>",
    )
    rows = {(r.doc_id, r.section): r.n_tokens for r in count_tokens(docs, PATH, "share", "parts").collect()}
    assert sum(v for (d, _), v in rows.items() if d == 1) == pytest.approx(3) and rows[1, 0] == pytest.approx(1.4)
    assert rows[2, -1] > 0 and not any(d == 3 for d, _ in rows) and rows[4, 0] == 2


def test_documents_without_sections_count(spark, odd_docs, tmp_path):
    from cellindex.llm.queries import QUERIES

    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op9_token_counts"](spark, str(tmp_path)).collect()
    plain = count_tokens(odd_docs, PATH, rule="majority").collect()
    bare = [tuple(r) for r in rows if r.section == -1]
    assert sorted(bare) == [(4, -1, -1, -1, 0.0, 0), (5, -1, -1, -1, 0.0, 0)]
    assert sorted((tuple(r) for r in rows if r.section >= 0), key=repr) == sorted(map(tuple, plain), key=repr)


def test_empty_table_and_unknown_rule(no_docs):
    assert count_tokens(no_docs, PATH).collect() == []
    with pytest.raises(ValueError):
        count_tokens(no_docs, PATH, rule="none")
