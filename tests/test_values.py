import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from scoutline.functions import values

AS_OF = datetime(2026, 10, 1, 12, tzinfo=timezone.utc)


def test_counts(evaluate):
    cases = {"20000": 20000, " 7 ": 7, "+7": 7, "-3": -3, "1.5": None, "n/a": None, "": None,
             None: None, "1_000": None}
    assert evaluate(values.to_count, list(cases)) == list(cases.values())


def test_numbers(evaluate):
    cases = {"0.05": 0.05, " 3 ": 3.0, "1e3": 1000.0, ".5": 0.5, "1d": None, "Not Found": None,
             "": None, None: None, "x": None}
    assert evaluate(values.to_number, list(cases)) == list(cases.values())


def test_flags(evaluate):
    cases = {"True": True, " yes ": True, "1": True, "1.0": False, "false": False, "": False, None: False}
    assert evaluate(values.to_flag, list(cases)) == list(cases.values())


def test_ages(evaluate):
    stamps = {
        (AS_OF - timedelta(days=90)).isoformat(): 90,
        (AS_OF - timedelta(days=91) + timedelta(seconds=1)).isoformat(): 90,
        "2026-10-01T13:00:00+01:00": 0,
        "2026-11-01": 0,
        "2026-09-30T11:59:59Z": 1,
        "2026-09-30 13:00": 0,
        "2026": None, "soon": None, "": None, "2026-13-01": None, None: None,
    }
    age = lambda c: values.days_since(values.to_timestamp(c), AS_OF)
    assert evaluate(age, list(stamps)) == list(stamps.values())


def test_json_text_equals_python(evaluate):
    texts = ["plain", 'a "b" \\ c', "tab\tnew\nline\r\x08\x0c\x01\x7f", "é☃", "\U0001f600x", ""]
    assert evaluate(values.json_string, texts) == [json.dumps(t) for t in texts]
    lists = [[], ["a"], ["a", 'é"'], None]
    assert evaluate(values.json_list, lists, "array<string>") == ["[]", '["a"]', json.dumps(["a", 'é"']), "[]"]


def test_bound_names_a_value(evaluate):
    assert evaluate(lambda c: values.bound(F.upper(c), lambda v: F.concat(v, v)), ["ab"]) == ["ABAB"]
