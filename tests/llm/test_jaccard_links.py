"""Numbers of links against all pairs."""

import pytest

from kinrate.llm.jaccard_join import Jaccard, jaccard_classes, jaccard_links

from .test_jaccard_join import FOLD, brute_force, near_copies


def all_links(pairs, rule):
    sets = []
    for _, text in pairs:
        words = (text or "").encode().translate(FOLD).split()
        whole = [tuple(words)] if words else []
        sets.append(frozenset([tuple(words[i : i + rule.width]) for i in range(len(words) - rule.width + 1)] or whole))
    counts = [0] * len(pairs)
    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (pairs[a][0], pairs[b][0]):
                if 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b]):
                    counts[a] += 1
                    counts[b] += 1
    return sorted(repr((doc, n)) for (doc, _), n in zip(pairs, counts))


@pytest.mark.parametrize("rule", [Jaccard(4, 85), Jaccard()])
def test_links_equal_all_pairs(docs_of, rule):
    pairs = near_copies(1, 6, 25, 80)
    pairs += [(2000, None), (2001, ""), (2003, "One two"), (2004, "one TWO"), (2003, "one two"), (None, "one two"),
              (2007, pairs[0][1])]
    rows = jaccard_links(docs_of(pairs), rule).collect()
    assert sorted(repr((r.doc_id, r.n_links)) for r in rows) == all_links(pairs, rule)
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in rows) == brute_force(pairs, rule)
    assert "n_links" not in jaccard_classes(docs_of(pairs), rule).columns
    assert jaccard_links(docs_of([]), rule).count() == 0
