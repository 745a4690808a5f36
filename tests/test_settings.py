from __future__ import annotations

import pytest

from postloom.sources import settings as S

TEXT = "[database]\nserver = s\n\n[keywords]\nbanned = Og,i;\n\tJOB\n\t\nbanned_english = the\n"


def test_settings(tmp_path):
    main, over = tmp_path / "a.ini", tmp_path / "b.ini"
    main.write_text(TEXT)
    over.write_text("[database]\nserver = other\n")
    assert S.load_settings(str(main)).stop_words == {"og", "i", "job", "the"}
    assert S.load_settings(str(main), str(over)).database["server"] == "other"
    assert S.load_settings(str(main), str(tmp_path / "none.ini")).database["server"] == "s"
    with pytest.raises(FileNotFoundError):
        S.load_settings(str(tmp_path / "none.ini"))
    main.write_text("[keywords]\nbanned = x\n")
    with pytest.warns(UserWarning, match="database"):
        assert S.load_settings(str(main)).stop_words == {"x"}


def test_lists(spark):
    assert S.parse_stop_list("A, b;\n\n;c ,,") == {"a", "b", "c"} and S.parse_stop_list(None) == set()
    words = {r[0] for r in S.stop_words(spark, S.Settings(stop_words=frozenset({"zzz"})), ("Salg",)).collect()}
    assert {"zzz", "salg", "og", "the", "job"} <= words
    assert S.category_urls(spark).count() == 249
    with pytest.raises(ValueError):
        S.category_urls(spark, 5, 4)
