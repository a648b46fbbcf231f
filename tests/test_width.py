import gzip

import pytest

from annulet.sources import text


@pytest.mark.parametrize("zipped", [False, True])
def test_width_of_first_lines(tmp_path, zipped):
    path, good = str(tmp_path / "a.tsv"), "\t".join("x" * 12) + "\n"

    def put(content):
        with gzip.open(path, "wt") if zipped else open(path, "w") as f:
            f.write(content)

    for content in ("", good * 3 + "\n" + good, good * 1000 + "short\n"):
        put(content)
        assert text.require_width(path) is None
    put(good + "\n" + "a\tb\n" * 2)
    with pytest.raises(ValueError) as e:
        text.require_width(path)
    assert str(e.value).split("\n")[1:] == ["Line 3: 2 fields < 12 required", "Line 4: 2 fields < 12 required"]
    put(good + "a\n" * 7)
    with pytest.raises(ValueError) as e:
        text.require_width(path)
    assert str(e.value).split("\n")[1:] == [*(f"Line {i}: 1 fields < 12 required" for i in range(2, 7)), "... and 2 more errors"]
