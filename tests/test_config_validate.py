import pytest

from tesserae.operators.validate import ConfigError, check, check_graph, validate
from tesserae.sources.config import Workspace, clamp_z, free_axis, parse

BASE = """
files: [a.raw, b.raw]
grid_spacing: 55
grid_spacing_error: 5
positions:
  tile_a: {start: [0, 0], reference_in_files: [0, 1]}
  tile_b: {start: [0, 0]}
"""


def test_defaults_null_and_scalar_at():
    c = parse(BASE + "overrides:\n  - {at: 3, drop: [tile_b], anchor: null}\n  - {at: [4, 5], realign: [tile_a]}\nslices: {z: [5, 100]}\n")
    assert c.overrides[0].at == (3,) and c.overrides[0].anchor == () and c.overrides[1].at == (4, 5)
    assert c.slices == ((5, 100), (None, None), (None, None))
    assert clamp_z(c.slices, 80)[0] == (5, 80) and free_axis(c.slices, 1)[0] == (5, 100)
    assert c.names_at("drop", 3) == {"tile_b"} and c.references_for_file(1) == {"tile_a"}


def test_missing_field_raises():
    with pytest.raises(KeyError):
        parse("files: [a]\npositions: {}\ngrid_spacing: 5\n")


def test_valid():
    assert check(parse(BASE), [5, 5]) == []


@pytest.mark.parametrize(
    "old, new, part",
    [
        ("[a.raw, b.raw]", "[a.raw, a.raw]", "file-twice"),
        ("grid_spacing_error: 5", "grid_spacing_error: 0", "tolerance:"),
        ("grid_spacing_error: 5", "grid_spacing_error: 30", "tolerance-wide"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [4, 0]}", "start-file"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [0, -1]}", "start-negative"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [1, 0], end: 1}", "lifeless"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [0, 0], aliases: [tile_b]}", "alias-self"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [0, 0], aliases: [tile_a]}", "alias-taken"),
        ("reference_in_files: [0, 1]", "reference_in_files: [0]", "file-unreferenced"),
        ("reference_in_files: [0, 1]", "reference_in_files: [0, 1, 1]", "reference-twice"),
        ("tile_b: {start: [0, 0]}", "tile_b: {start: [0, 9]}", "start-late"),
    ],
)
def test_one_mutation_one_problem(old, new, part):
    assert any(x.startswith(part) for x in check(parse(BASE.replace(old, new)), [5, 5]))


@pytest.mark.parametrize(
    "block, part",
    [
        ("{at: [], drop: [tile_b]}", "block-times"),
        ("{at: -1, drop: [tile_b]}", "time-negative"),
        ("{at: 1}", "block-idle"),
        ("{at: 1, drop: [nobody]}", "use-unknown"),
        ("{at: 1, drop: [tile_b], realign: [tile_b]}", "use-dropped"),
        ("{at: 1, unanchor: [tile_a], anchor: [tile_a]}", "use-both"),
        ("{at: 1, unanchor: [tile_b], drop: [tile_b]}", "use-needless"),
        ("{at: 0, realign: [tile_a]}", "realign-first"),
        ("{at: 1, drop: [tile_a]}", "block-bare"),
        ("{at: 99, drop: [tile_b]}", "time-late"),
        ("{at: 2, realign: [tile_a]}", "realign-region"),
    ],
)
def test_override_rules(block, part):
    assert any(x.startswith(part) for x in check(parse(BASE + f"overrides:\n  - {block}\n"), [5, 5]))


def test_all_problems_are_collected():
    bad = parse(BASE.replace("grid_spacing_error: 5", "grid_spacing_error: 0").replace("[0, 1]", "[7]"))
    with pytest.raises(ConfigError) as e:
        validate(bad)
    assert len(e.value.problems) >= 3


def test_graph_rules():
    out = check_graph(3, {0: ["a", "b"], 1: ["a"]}, {0: {"a"}, 1: {"a", "b"}}, {})
    assert out == ["empty: all tiles are gone at t = 2", "unanchored: no anchor holds the part b at t = 0"]
    assert Workspace.of("/x/run.yaml").offsets.as_posix() == "/x/run/offsets.jsonl"


def test_every_rule_has_a_breach():
    """Rules of one configuration that is wrong in many ways, by their codes."""
    text = """
files: [a.raw, a.raw]
grid_spacing: 8
grid_spacing_error: 5
positions:
  p: {start: [0, -1], end: 9, aliases: [p, q], reference_in_files: [0, 0, 5]}
  q: {start: [1, 7], end: 1, reference_in_files: [0]}
slices: {z: [0, 3]}
realignment_slices: {z: [0, 3]}
overrides:
  - {at: [0, 3, -2], drop: [p, q], unanchor: [p], realign: [q, r]}
  - {at: [3, 2, 44], anchor: [q], unanchor: [q]}
  - {at: []}
"""
    codes = {x.split(":")[0] for x in check(parse(text), [2, 2], True, "/nowhere")}
    assert codes == {
        "tolerance-wide", "realign-same", "file-twice", "file-missing", "file-unreferenced", "start-negative", "start-late", "end-file", "lifeless", "alias-self", "alias-taken", "reference-file", "reference-lifeless", "reference-twice",
        "block-times", "block-idle", "block-bare", "time-negative", "time-shared", "time-late", "realign-first", "use-unknown", "use-dropped", "use-both", "use-needless", "call-lifeless", "call-early",
    }
    assert [x.split(":")[0] for x in check(parse("files: []\npositions: {}\ngrid_spacing: 5\ngrid_spacing_error: 0\n"), [1])] == ["no-files", "no-positions", "tolerance", "lengths"]
    assert any(x.startswith("call-early") for x in check(parse(BASE.replace("tile_b: {start: [0, 0]}", "tile_b: {start: [0, 3]}") + "overrides:\n  - {at: 1, drop: [tile_b]}\n"), [5, 5]))
