"""What counts as a letter when a language is predicted."""

import sys
import unicodedata

from hourloom.llm.language import has_letter


def test_letters_are_those_of_category_l():
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        assert has_letter(char) == unicodedata.category(char).startswith("L"), hex(code)


def test_numerals_are_none():
    assert not has_letter("½ ² ① Ⅷ 12_3") and has_letter("½ ² ① é") and not has_letter("")
