"""Blocks of frequent tokens with equal members count once only where the members' sides are equal too."""

from tidemark.llm import line_dedup


def test_sides_tell_groups_apart(llm):
    size = 10 << 32
    dealt = lambda g, sides: [(g, d1, size, 0, (side << 42) | 1) for d1, side in zip((11, 12, 13), sides, strict=True)]
    # Two tokens of two and three blocks: all three sets are left in block (0, 1) of both, on other sides.
    rows = dealt(1, (0, 1, 1)) + dealt(2, (0, 0, 1)) + dealt(3, (0, 1, 1))
    met = line_dedup.members_with_partners(llm.createDataFrame(rows, "g bigint, d1 bigint, shape bigint, bitmap bigint, block bigint"), 0.8).collect()
    sums = {g: {r["s"] for r in met if r["g"] == g} for g in (1, 2, 3)}
    assert sorted((r["g"], r["d1"]) for r in met) == [(g, d) for g in (1, 2, 3) for d in (11, 12, 13)]
    assert all(len(s) == 1 for s in sums.values()) and sums[1] == sums[3] and sums[1] != sums[2]
