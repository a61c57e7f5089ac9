import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rxlens.llm import transforms

TEXTS = st.lists(st.text("ab\xe9", max_size=20).map(str.encode), min_size=1, max_size=8)


def shared_ends(a, b):
    n = 0
    while n < len(a) and a[-1 - n] == b[-1 - n]:
        n += 1
    return n


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_suffixes_are_sorted_and_the_text_comes_back(texts):
    whole = b"".join(texts)
    order = transforms.suffix_array(np.frombuffer(whole, dtype=np.uint8)).tolist()
    assert order == sorted(range(len(whole) + 1), key=lambda i: whole[i:])
    made = transforms.transform(texts)
    assert transforms.read_back(made) == whole
    ends = np.cumsum([len(t) for t in texts])
    assert [order[r] for r in made.ends] == ends.tolist()


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 4), st.integers(1, 7))
def test_merge_equals_comparing_all_windows(texts, shards, depth):
    dealt = [texts[i::shards] for i in range(shards) if texts[i::shards]]
    counts = [np.array([max(0, len(t) - depth + 1) for t in shard]) for shard in dealt]
    found = transforms.common_lengths([transforms.transform(x) for x in dealt], counts, depth)
    windows = [t[i : i + depth] for s in dealt for t in s for i in range(len(t) - depth + 1)]
    want = []
    for i, w in enumerate(windows):
        best = max((shared_ends(w, v) for j, v in enumerate(windows) if j != i), default=0)
        want.append(best if best == depth else best // 2 * 2)
    assert np.concatenate(found).tolist() == want


def test_interleave_of_shards_equals_that_of_the_joint_transform():
    texts = [b"abracadabra", b"alakazam", b"", b"abracadabra", b"zzzzzzzzzz", b"z"]
    counts = np.array([max(0, len(t) - 3) for t in texts])
    (joint,) = transforms.common_lengths([transforms.transform(texts)], [counts], 4)
    parts = transforms.common_lengths(
        [transforms.transform([t]) for t in texts], [counts[i : i + 1] for i in range(6)], 4
    )
    assert np.concatenate(parts).tolist() == joint.tolist()
    assert joint[:8].tolist() == [4] * 8 and joint[-7:].tolist() == [4] * 7
