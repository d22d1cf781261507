import itertools
import re

from caseloom.llm import tokens


def test_runs_of_spaces_as_by_a_pattern():
    """Every text of up to four of these characters, against the pattern that says what a run is."""
    pattern = re.compile(r"[ \n][ \n\t\r]|[\t\r\x00]|\A[ \n]|[ \n]\Z|\A\Z")
    for n in range(5):
        for text in map("".join, itertools.product(" \n\t\r\0ab", repeat=n)):
            assert tokens._runs(text) == bool(pattern.search(text)), repr(text)
