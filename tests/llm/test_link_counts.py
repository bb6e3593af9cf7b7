"""Links within classes are counted from departures, not pair by pair."""

import random

import pytest

from kinrate.llm import jaccard_join, link_counts
from kinrate.llm.jaccard_join import Jaccard, jaccard_links
from kinrate.plans.storage import rows_of

from .conftest import made_words
from .test_jaccard_join import brute_force
from .test_jaccard_links import all_links


def variants(seed, copies, words, edits, kinds=10**6):
    """Texts that replace some words of one text, by one of ``kinds`` words each."""
    random_ = random.Random(seed)
    base = made_words(seed, words, 3000)
    texts = []
    for _ in range(copies):
        text = list(base)
        for _ in range(random_.randint(*edits)):
            text[random_.randrange(words)] = f"e{random_.randrange(kinds)}"
        texts.append(" ".join(text))
    return texts


def same_links(docs_of, pairs, rule):
    rows = jaccard_links(docs_of(pairs), rule).collect()
    assert sorted(repr((r.doc_id, r.n_links)) for r in rows) == all_links(pairs, rule)
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in rows) == brute_force(pairs, rule)


@pytest.mark.parametrize("rule", [Jaccard(4, 85), Jaccard(2, 20)])
def test_links_of_groups_of_many_shapes(docs_of, monkeypatch, rule):
    monkeypatch.setattr(link_counts, "LIST_PART", 5)  # lists are dealt to several parts
    texts = variants(1, 60, 60, (0, 4)) + variants(2, 40, 30, (0, 2), kinds=3)
    chain = made_words(9, 60, 3000)
    texts += [" ".join(chain[i : i + 40]) for i in range(20)]  # ends of a class have few shingles in common
    texts += ["a b c d e f", "f e d c b a", "a b c f e d", "x y", "y x", "x Y", "x"]
    texts += [texts[3], texts[70], texts[70].upper()]
    random.Random(5).shuffle(texts)
    pairs = list(enumerate(texts)) + [(7, texts[7]), (8, texts[9]), (None, texts[3]), (900, None), (901, " ")]
    same_links(docs_of, pairs, rule)


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(docs_of, monkeypatch):
    handed = []
    compare = jaccard_join.compare

    def counted(pairs, *rest):
        handed.append(rows_of(pairs))
        return compare(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "compare", counted)
    pairs = list(enumerate(variants(3, 80, 300, (1, 2))))
    same_links(docs_of, pairs, Jaccard(4, 85))
    assert sum(handed) < 80 * 5
