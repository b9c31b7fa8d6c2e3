import pytest
import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import secrets

from .conftest import prose

AWS, HEX = "AK" + "IA" + "Q" * 18, "0f" * 14


def slow(text, rules=secrets.RULES):
    spans = []
    for k, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.ASCII | (re.IGNORECASE if rule.anycase else 0)):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), k, m.end()))
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in sorted(spans))


def test_spans_equal_a_full_scan(make, odd):
    texts = [
        f"é PassWord = '{HEX}'", f"token:{AWS} {AWS}", "password=token: abcdefgh", "secret: abc", "api_key=ABCDEFG apikey:1234567",
        f"{HEX}{HEX}x{HEX}", "AKIA" + "1" * 10, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890-abc", prose(4), None, "",
        "gh" + "p_" + "a" * 40, "sk_" + "live_" + "b" * 24, "PASSWORD" + " " * 50 + "=" + "z" * 9,
    ]
    docs = make([(i, t, None, None) for i, t in enumerate(texts)])
    rows = {r.doc_id: r for r in secrets.digests(docs).collect()}
    for i, text in enumerate(texts):
        assert rows[i].spans == slow(text)
        assert rows[i].base_sha256 == hashlib.sha256(slow(text, secrets.BASE).encode()).hexdigest()
    assert rows[1].n_assign == 1 and rows[1].n_access == 2 and rows[2].n_assign == 0
    assert secrets.digests(odd).count() == odd.count()
    assert secrets.digests(odd.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAkKiIePpsSwWoOrRdDtTnN_:= '\"01fé", max_size=60), st.sampled_from(secrets.RULES))
def test_queries_hold_for_every_match(text, rule):
    flags = re.ASCII | (re.IGNORECASE if rule.anycase else 0)
    if re.search(rule.pattern, text, flags):
        low = "".join(c.lower() if c.isascii() else c for c in text)
        have = {low[i : i + 3] for i in range(len(low) - 2)}

        def holds(query):
            if query is None:
                return True
            if isinstance(query, str):
                return query in have
            return (all if query[0] == "and" else any)(map(holds, query[1]))

        assert holds(secrets.query_of(rule))


def test_derived_queries():
    assert secrets.query_of(secrets.Rule("x", "abcd")) == ("and", frozenset({"abc", "bcd"}))
    assert secrets.query_of(secrets.Rule("x", "(abc|xyz)+")) == ("or", frozenset({"abc", "xyz"}))
    assert secrets.query_of(secrets.Rule("x", "ab?c")) is None and secrets.query_of(secrets.Rule("x", "[a-z]+")) is None
    assert secrets.trigrams_in(secrets.query_of(secrets.Rule("x", "key[0-9]*=val"))) == {"key", "=va", "val"}


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_postings_name_the_texts_that_have_a_trigram(make, tasks):
    rows = [(1, "my Token", None, None), (2, "ok", None, None), (3, "tokens", None, None), (3, "tokens", None, None), (None, "token", None, None)]
    docs = make(rows).repartition(tasks)
    found = {(r.trigram, r.part): r.doc_ids for r in secrets.postings(docs).collect()}
    assert found["tok", 0] == [1, 3, 3]
    cut = secrets.postings(docs, listed=1).where("trigram = 'tok'").collect()
    assert len(cut) > 1 and sorted(i for r in cut for i in r.doc_ids) == [1, 3, 3]
    assert secrets.postings(docs.where("false")).count() == 0
