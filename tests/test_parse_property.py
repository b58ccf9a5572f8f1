"""Property test: the Spark front end against a plain-Python statement of rules Q1-Q4.

Lines are random mixes of markers, letters (ASCII and accented), digits,
punctuation and non-BMP characters; the whole batch goes through one Spark job.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from verbum.operators import parse as ps

PIECES = st.sampled_from(['id="', '" url=', '">', "</doc>", "id", "url=", '"', "<", ">", " ", "  ", "\t"])
CHARS = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs", "Cc")) | st.sampled_from("aZé ü,.-9"),
                max_size=12)
LINE = st.lists(st.one_of(PIECES, CHARS), max_size=12).map("".join)
WELL_FORMED = st.tuples(st.sampled_from(["AU", "WK", "au", ""]), st.text(alphabet="0123456789", max_size=4), CHARS,
                        st.lists(st.one_of(CHARS, PIECES), max_size=8).map("".join)).map(
    lambda t: f'<doc id="{t[0]}{t[1]}" url="http://{t[2]}" title="x">{t[3]}</doc>')


def brute_force(line: str):
    if not ("id" in line and "url=" in line):
        return None
    i, j, k = line.find('id="'), line.find('" url='), line.find('">')
    if i < 0 or j < 0 or k < 0:
        return None
    key = line[i + 4:j] if j >= i + 4 else ""
    rest = line[k + 2:]
    body = rest[:max(len(rest) - 6, 0)]
    words = re.sub("[^a-zA-Z]+", " ", body).lower().split(" ")
    return key, tuple(w for w in words if w)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(LINE, WELL_FORMED), min_size=1, max_size=40))
def test_front_end_matches_python_rules(lines, values):
    got = sorted((r.doc_key, tuple(r.words)) for r in ps.corpus_tokens(lines(values)).collect())
    want = sorted(x for x in map(brute_force, values) if x is not None)
    assert got == want
