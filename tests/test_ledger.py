import os
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseloom.operators import ledger


def logged(folder, fails=(), dies_at=None):
    """Provider that notes every prompt it sees; some fail, and at one the whole task does."""

    def provider(prompts):
        for p in prompts:
            if p == dies_at:
                raise KeyboardInterrupt
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(p)
        return [RuntimeError("down") if p in fails else p.upper() for p in prompts]

    return provider


def seen(folder):
    return sorted(f.read_text() for f in folder.iterdir())


@pytest.fixture
def folders(tmp_path):
    made = [tmp_path / n for n in ("first", "second", "third")]
    for f in made:
        f.mkdir()
    return made


def results(df):
    return {r["n"]: (r["generated"]["raw"], r["generated"]["error"]) for r in df.collect()}


def test_only_unanswered_prompts_are_asked(rows, folders, tmp_path):
    df = rows([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "n int, prompt string")
    place = str(tmp_path / "ledger")
    out = ledger.ask_once(df, "prompt", logged(str(folders[0]), {"b"}), place)
    assert out.columns == ["n", "prompt", "generated"]
    assert results(out) == {1: ("A", None), 2: (None, "down"), 3: ("A", None), 4: (None, None), 5: ("", None)}
    assert seen(folders[0]) == ["", "a", "b"]
    more = df.unionByName(rows([(6, "c")], "n int, prompt string"))
    again = ledger.ask_once(more, "prompt", logged(str(folders[1])), place)
    assert results(again) == {1: ("A", None), 2: ("B", None), 3: ("A", None), 4: (None, None), 5: ("", None), 6: ("C", None)}
    assert seen(folders[1]) == ["b", "c"]
    assert results(ledger.ask_once(more, "prompt", logged(str(folders[2])), place)) == results(again)
    assert seen(folders[2]) == []
    assert results(out)[2] == (None, "down")  # an earlier result stays as it was


def test_a_failed_run_leaves_its_answers(rows, folders, tmp_path):
    prompts = [f"p{i}" for i in range(8)]
    df = rows(list(enumerate(prompts)), "n int, prompt string")
    place = str(tmp_path / "ledger")
    with pytest.raises(Exception):
        ledger.ask_once(df, "prompt", logged(str(folders[0]), dies_at="p5"), place, prompts_per_file=1)
    paid = seen(folders[0])
    assert results(ledger.ask_once(df, "prompt", logged(str(folders[1])), place)) == {i: (p.upper(), None) for i, p in enumerate(prompts)}
    assert seen(folders[1]) == sorted(set(prompts) - set(paid))


def test_a_repeated_task_reads_what_it_wrote(folders, tmp_path):
    batch = pa.RecordBatch.from_pydict({"digest": ["1", "2", "3", "4", "5"], "prompt": ["a", "b", "c", "d", "e"]})
    place = str(tmp_path / "slices")
    first = ledger.recorded(logged(str(folders[0]), {"b"}, dies_at="e"), place, 2)
    got = []
    with pytest.raises(KeyboardInterrupt):
        for part in first(iter([batch])):
            got += part.to_pylist()
    assert len(got) == 4 and seen(folders[0]) == ["a", "b", "c", "d"]
    second = ledger.recorded(logged(str(folders[1])), f"file:{place}", 2)
    all_of_it = [r for part in second(iter([batch])) for r in part.to_pylist()]
    assert all_of_it[:4] == got and all_of_it[4]["raw"] == "E" and all_of_it[1]["error"] == "down"
    assert seen(folders[1]) == ["e"]


def test_no_prompts(rows, folders, tmp_path):
    df = rows([(1, None)], "n int, prompt string")
    assert results(ledger.ask_once(df, "prompt", logged(str(folders[0])), str(tmp_path / "l"))) == {1: (None, None)}
    assert ledger.ask_once(df.where(F.lit(False)), "prompt", logged(str(folders[0])), str(tmp_path / "l")).collect() == []
