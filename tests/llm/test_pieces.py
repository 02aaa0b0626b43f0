import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm import pieces as p

TEXTS = st.lists(
    st.one_of(
        st.text(alphabet="ab9'strevdml .,\n\t\r", max_size=25),
        st.text(alphabet="aZ0' \néßñÀɏ×÷ɐ\x00\x85\xa0一²", max_size=12),
        st.sampled_from(["'", "''s", "it's", "we're'll", "'ve", "'v", "'r", "a'", "  ", "a  b", "a \n b", " \n", "x" * 40 + " y"]),
    ),
    max_size=12,
)


def encode(words):
    return [np.array([len(w.encode()), *w.encode()], "<u4").tobytes() for w in words]


def odd(texts):
    return [b"".join(encode(p._EXACT.findall(x))) for x in texts]


def as_bytes(texts):
    raw = [x.encode() for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@settings(max_examples=600, deadline=None)
@given(TEXTS, TEXTS)
def test_pieces_are_the_matches_of_the_pattern(first, second):
    known = p.Pieces(encode, odd)
    for texts in (first, second, first):
        assert known.texts(*as_bytes(texts)) == odd(texts)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_strange_texts_are_those_of_other_characters(texts):
    assert p.strange_texts(*as_bytes(texts)).tolist() == [bool(p._ODD.search(x)) for x in texts]


def test_many_pieces_and_forgetting(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(p, "REMEMBERED", 50_000)
    known = p.Pieces(encode, odd)
    for _ in range(4):
        texts = [" ".join(f"w{i}" if i % 3 else "x" * (i % 30) for i in rng.integers(0, 10**9, 20_000)) for _ in range(3)]
        assert known.texts(*as_bytes(texts)) == odd(texts)
    assert known.n <= 50_000 + 120_000


def test_marked_texts_go_as_a_whole():
    known = p.Pieces(encode, lambda texts: [x.upper().encode() for x in texts])
    got = known.texts(*as_bytes(["ab c", "", "d"]), np.array([False, False, True]))
    assert got == [odd(["ab c"])[0], b"", b"D"]
