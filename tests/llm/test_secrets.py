import random
import re

from folioflow.llm.secret_scan import Rule, Scanner, scan_secrets

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = {"assign", "access", "hex"}
SCANNER = Scanner()


def expected(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], b, e) for b, k, e in sorted(found)]


def test_base_rules_match_a_regular_expression_engine():
    rng = random.Random(7)
    bits = ["password", "PassWd", "Token", "secret", "api_key", "apikey", ":", "=", " ", "'", '"', "abc", "0123abcdef"]
    bits += ["AKIA", "ABCD12", "é", "日本", "deadbeef" * 4, "\n", "pass", "se", ".", "-"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert [x for x in SCANNER.find(text) if x[0] in BASE] == expected(text), text


def test_a_failing_match_uses_up_its_text():
    assert SCANNER.find("password: token: abcdefgh1") == []
    assert SCANNER.find("token=secret=abcdefgh") == [("assign", 0, 21)]


def test_further_kinds():
    text = "x ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY-----"
    assert [k for k, _, _ in SCANNER.find(text)] == ["github", "pem"]


def test_automaton_is_small_and_own_rules_work():
    assert len(SCANNER.all.step) < 3000
    one = Scanner((Rule("id", r"id-[0-9]{3,5}(x|yz)?"),))
    assert one.find("id-12 id-1234yz id-123456") == [("id", 6, 15), ("id", 16, 24)]


def test_edge_rows(docs_frame):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "é token=abcdefgh9", None)]
    df = scan_secrets(docs_frame(rows, ", secrets string"))
    got = {(r["doc_id"], len(r["secrets"])) for r in df.collect()}
    assert got == {(1, 0), (2, 0), (None, 1)} and df.count() == 4
    assert df.where("doc_id is null").first()["secrets"][0]["start"] == 2
    assert scan_secrets(docs_frame([])).collect() == []


def test_long_text(docs_frame):
    text = "lorem ipsum " * 50_000 + "password=abcdefgh12"
    spans = scan_secrets(docs_frame([(1, text)])).first()["secrets"]
    assert [(s["kind"], s["start"]) for s in spans] == [("assign", 600_000)]
