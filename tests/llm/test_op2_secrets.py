import hashlib
import random
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.queries import op2_secrets
from quern.llm.secrets import _at_least, base_spans, battery, candidates, find_secrets, spans_digest
from tests.compare import SMALL

KINDS = ["assign", "access", "hex"]


def plain(text):
    """The contract, kind by kind."""
    text, out = text or "", []
    for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end()))
    return sorted(out)


PIECES = st.sampled_from(["password", "Passwd=", "secret", "TOKEN: ", "api_key", "apikey='", ":", "=", '"', " ", "abc", "abcdef", "AKIA", "AKIA" + "A1" * 8, "0123456789abcdef", "é", "\U0001f600", "K", "ſecret=abcdef", "/+._-"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_base_spans_are_the_contract(text):
    assert base_spans(text) == plain(text)


def test_dropped_match_hides_what_it_covers():
    assert base_spans("secret=token:abcdef12") == [] and len(base_spans("secret=token:abcdef12 token:abcdef12")) == 1


def test_battery_tells_random_from_ordinary():
    rng = random.Random(5)
    alphabet = string.ascii_letters + string.digits + "+/"
    strong = [battery("".join(rng.choice(alphabet) for _ in range(40)))[1] for _ in range(50)]
    weak = [x[1] if x else 1.0 for x in map(battery, ["configuration-file-name-2024-version", "aaaaaaaaaaaaaaaaaaaa1111", "abcdefghijklmnopqrstuvwxyz012345", "SomeLongCamelCaseIdentifierName", "path/to/some/directory/with/files"])]
    assert sorted(strong)[45] < 1e-4 and min(weak) > 1e-3
    assert battery("1234567890" * 3) is None and battery("onlylowercaselettershere") is None


def test_query_on_all_rows(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op2_secrets(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in want) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in joined.split(",") if x]


def test_random_tokens_among_ordinary_ones(spark):
    rng = random.Random(2)
    token = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    rows = [(i, f"see {token(40)} now", 1) for i in range(20)] + [(100 + i, "see the-quite-ordinary-identifier-number-%d now" % i, 1) for i in range(200)]
    rows += [(500, None, 1), (501, "", 1), (None, "password=abcdef", 1), (502, "x" * 300_000 + " token=abcdefg", 1), (502, "x" * 300_000 + " token=abcdefg", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = spans_digest(find_secrets(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert sum(by[i].n_random for i in range(20)) >= 19 and sum(by[100 + i].n_random for i in range(200)) == 0
    assert by[500].spans == by[501].spans == "" and by[None].n_assign == 1 and by[502].spans == "assign:300001:300014"
    assert spans_digest(find_secrets(df.limit(0))).count() == 0


def test_column_order(spark):
    assert op2_secrets(spark, SMALL).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]


def test_tail_is_the_binomial_at_every_length():
    from fractions import Fraction
    from math import comb

    for m in (1, 19, 200, 201, 700):
        for runs in {0, 1, m // 4, m // 2, m}:
            exact = sum(Fraction(comb(m, i) * 3 ** (m - i), 4**m) for i in range(runs, m + 1))
            assert abs(_at_least(runs, m, 0.25) / float(exact) - 1) < 1e-9 if float(exact) > 1e-300 else _at_least(runs, m, 0.25) < 1e-290
    assert 0 < _at_least(30_000, 100_000, 0.25) < 1e-100


def test_claims_are_benjamini_hochberg(spark):
    """Over all documents, stratum by stratum: the largest k with p(k) <= k / n * rate, on the stated grid."""
    rng = random.Random(9)
    made = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    texts = []
    for i in range(300):
        words = [made(string.ascii_letters + string.digits, rng.randrange(20, 60)) if rng.random() < 0.2 else "-".join(made("etaoinsh", rng.randrange(3, 9)) for _ in range(6)) + str(rng.randrange(99))]
        words.append(made("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 26) if rng.random() < 0.3 else "Ab1" * rng.randrange(7, 12))
        texts.append(" ".join(words))
    found = {r.doc_id: {(s.start, s.end) for s in r.spans if s.kind == 3} for r in find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    strata = {}
    for i, t in enumerate(texts):
        for start, end, stratum, step in candidates(t, base_spans(t)):
            strata.setdefault(stratum, []).append((10 ** (-step / 10), i, start, end))
    want = {i: set() for i in range(len(texts))}
    for own in strata.values():
        ps = sorted(x[0] for x in own)
        passing = [p for k, p in enumerate(ps, 1) if p <= 0.01 * k / len(ps)]
        for p, i, start, end in own:
            if passing and p <= max(passing):
                want[i].add((start, end))
    assert found == want and 0 < sum(map(len, want.values())) < sum(map(len, strata.values()))
