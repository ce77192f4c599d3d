"""Property tests of the separator chunks (pure Python helper, no Spark)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.chunking import cut_places

text_st = st.text(alphabet=st.sampled_from(list("ab cd\n\n\t,.")), min_size=0, max_size=400)


@settings(max_examples=300, deadline=None)
@given(text=text_st, size=st.integers(5, 60), overlap_frac=st.floats(0, 0.9))
def test_chunks_are_bounded_and_cover_the_text(text, size, overlap_frac):
    overlap = int(size * overlap_frac)
    places = list(cut_places(text, size, overlap))
    assert all(0 < b - a <= size for a, b in places)
    if not text:
        assert places == []
        return
    assert places[0][0] == 0 and places[-1][1] == len(text)
    for (a, b), (c, d) in zip(places, places[1:]):
        assert a < c <= b < d and b - c <= overlap  # nothing is left out, and overlaps are short
        if b - a < size:
            assert text[b - 1] in " \n"
