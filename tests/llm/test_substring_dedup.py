import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from kinrate.llm.substring_dedup import remove_repeats

from .conftest import made_words


def brute_force(pairs, k):
    """For each row: words, removed words, digest of the rest."""
    rows = [(i, (t or "").encode().split()) for i, t in pairs]
    first = {}
    for i, words in rows:
        for s in range(len(words) - k + 1):
            key = tuple(words[s : s + k])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    result = []
    for i, words in rows:
        gone = [False] * len(words)
        for s in range(len(words) - k + 1):
            if i is not None and first[tuple(words[s : s + k])] < i:
                gone[s : s + k] = [True] * k
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        result.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, result))


def spark_rows(docs, k, anchor):
    rows = remove_repeats(docs, k, anchor).collect()
    return sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in rows)


def test_planted_spans(docs_of):
    a, b, c = (made_words(s, 200) for s in (1, 2, 3))
    pairs = [
        (5, " ".join(a)),
        (7, " ".join(b[:60] + a[20:90] + b[60:])),  # a long span inside
        (8, "\n".join(b[:60] + a[20:90] + c[:40])),
        (9, " ".join(c + a[40:89])),  # one word short
        (10, " ".join(a)),  # an exact copy
        (10, " ".join(a)),  # a repeated row
        (11, " ".join(a[:50] * 3)),
        (3, " ".join(c[100:160])),  # earlier than where it stands
        (None, " ".join(a)),
        (12, None),
        (13, ""),
        (14, "  x y z"),
    ]
    assert spark_rows(docs_of(pairs), 50, 8) == brute_force(pairs, 50)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=8), st.integers(1, 3))
def test_small_alphabets(docs_of, texts, anchor):
    pairs = [(i % 6, " ".join(t)) for i, t in enumerate(texts)]
    assert spark_rows(docs_of(pairs), 5, anchor) == brute_force(pairs, 5)


def test_empty_table_and_kept_text(docs_of):
    assert remove_repeats(docs_of([])).count() == 0
    words = made_words(4, 80)
    rows = remove_repeats(docs_of({1: " ".join(words), 2: "x  y " + " ".join(words) + " z"})).collect()
    kept = {r.doc_id: r.kept_text for r in rows}
    assert kept == {1: " ".join(words), 2: "x y z"}
    assert {r.doc_id: r.other.words for r in rows} == {1: "x", 2: "x"}


def test_parameters_are_checked(docs_of):
    with pytest.raises(ValueError):
        remove_repeats(docs_of({1: "a"}), 5, 6)
