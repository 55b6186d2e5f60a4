"""A document goes only if none of its lines with words is left."""

from tidemark.llm import line_dedup

from .conftest import frame

LICENCE = "this text may be used by anyone for any purpose at all"


def kept(llm, texts, **floor):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    return {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.without_copied_lines(frame(llm, rows), **floor).collect()}


def test_lines_below_a_floor_keep_their_document(llm):
    poem = "\n".join(f"verse {i}" for i in range(100))
    texts = [f"{LICENCE}\nown words", f"{poem}\n{LICENCE}", LICENCE, f"\n{LICENCE}\n \n", "\n\n", None]
    for floor in ({}, {"min_words": 5}):
        left = kept(llm, texts, **floor)
        assert left == {0: (texts[0], 0), 1: (poem, len(poem)), 4: ("\n\n", 0), 5: (None, 0)}, floor
