"""Base spans against the plain patterns, discovery on planted cues, masking."""

import hashlib
import random
import re

from fichario.llm import pii
from fichario.llm.catalog import op4_pii


def slow(text):
    text, out = text or "", []
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(d := re.sub("[^0-9]", "", x)) <= 19 and sum(
            int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(re.sub("[^0-9]", "", x)) <= 15),
    }
    for kind, (pattern, ok) in kinds.items():
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if ok(m[0])]
    return out


def fast(text):
    spans = pii.base_spans(text)
    return [f"{k}:{s}:{e}" for k in pii.KINDS for s, e in spans[k]]


def test_base_spans_of_random_texts():
    random.seed(5)
    bits = ["a@b.c", "@", ".", "x.y", "@d-e.f.g", "1.2.3.4", "256.1.1.1", "00255.1.2.3", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (988) 555-2485", "+", " ", "-", "é", "7", "79927398713", "\n", "..", "%_", "1.2.3.4.5.6.7.8",
            "+49.30.1234567 ", "(", "0" * 20, "٣", "K"]
    for _ in range(4000):
        text = "".join(random.choices(bits, k=random.randrange(1, 14)))
        assert fast(text) == slow(text), text
    assert fast(None) == fast("") == []


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "a." * 150_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000,
                 "+1" + " " * 300_000, "+1" * 150_000, "1 " * 150_000, "+1 (" * 70_000, "a=" * 150_000, "a: " * 100_000,
                 "=" * 300_000, "A1 " * 100_000, "A" * 300_000 + " 1", "x:1 " * 70_000, 'a="' * 100_000):
        spans = pii.base_spans(text)
        list(pii.occurrences(text, spans))


def test_whole_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_pii(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        want = slow(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("id:")] == want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s.startswith(k) for s in want) for k in pii.KINDS]


def test_cues_discover_unseen_identifiers(spark):
    rows = [(n, f"Some plain words here. Write to: user{n}@mail.example.com and more of it in {n} days") for n in range(60)]
    rows += [(100, "As before. Write to: nick-77-home please"), (101, "more of it in 4417 days, plain 9921 words here 88123"),
             (102, None), (103, ""), (None, "Write to: nobody at all. Write to: agent-007-x"), (100, "As before. Write to: nick-77-home please")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    found = pii.find(docs).collect()
    assert len(found) == len(rows)
    ids = sorted((str(r.doc_id), r.spans) for r in found if r.n_id)
    text = rows[60][1]
    at = text.index("nick")
    odd = rows[64][1].index("agent")
    assert ids == [("100", f"id:{at}:{at + 12}")] * 2 + [("None", f"id:{odd}:{odd + 11}")]
    clean = {(r.doc_id, r.text) for r in pii.without_pii(docs).collect()}
    assert clean == {(r.doc_id, r.text) for r in pii._joined_masks(docs).collect()}
    assert (100, "As before. Write to: [ID] please") in clean
    assert (101, rows[61][1]) in clean and (102, None) in clean and (103, "") in clean
    assert pii.without_pii(docs).columns == docs.columns and pii.without_pii(docs).count() == len(rows)
    assert pii.find(docs.limit(0)).count() == 0 and pii.without_pii(docs.limit(0)).count() == 0


def test_support_of_a_cue_does_not_grow_with_the_seeds(spark):
    rows = [(n, " ".join(f"w{n}x{k} v{n}x{k} p{n}x{k}@mail.example.com" for k in range(100))) for n in range(200)]
    rows += [(1000 + n, f"his staff badge: u{n % 8}@mail.example.com today") for n in range(16)]
    rows += [(2000, "his staff badge: kx-4471 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")  # 20,008 seeds, 8 of them behind the cue
    assert [(r.doc_id, r.spans) for r in pii.find(docs).filter("n_id > 0").collect()] == [(2000, "id:17:24")]
    assert [r.text for r in pii.without_pii(docs).filter("doc_id = 2000").collect()] == ["his staff badge: [ID] today"]


def test_early_bounds_change_no_score(spark, monkeypatch):
    random.seed(3)
    rows = [(n, " ".join(f"{random.choice('abcd' if n_often else 'wxyz')} {random.choice('efg')} " + random.choice(
        [f"u{random.randrange(40)}@x.example.com", f"id-{random.randrange(60)}", "plain"] + ["u7@x.example.com"] * n_often)
        for _ in range(12))) for n, n_often in enumerate([0, 20] * 150)]
    rows += [(1000 + n, f"send to: u{n}@x.example.com or id-{n} send to: id-{n % 9}00") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def scores(parts):
        monkeypatch.setattr(pii, "PARTS", parts)
        return sorted((r.h, round(r.score, 9)) for r in pii._confident(pii._scanned(docs), docs)[1].collect())

    want = scores(())
    assert want and scores((4, 2)) == scores((256, 16)) == want
    for limit in (10, 0):
        monkeypatch.setattr(pii, "ROW_PATTERNS", 0)
        monkeypatch.setattr(pii, "BROADCAST_PATTERNS", limit)
        assert scores((4,)) == want


def test_masks_of_overlapping_spans():
    assert pii.masked("call +1 (988) 555-2485 4111111111111111!", "card:23:39,phone:5:39") == "call [PHONE]!"
    assert pii.masked("a b@c.de", "email:2:8") == "a [EMAIL]"


def test_keys_by_shape_teach_their_contexts(spark):
    random.seed(11)
    key = lambda n: "".join(random.choices("0123456789abcdef", k=n))
    keys = [key(40) for _ in range(30)]
    rows = [(n, f'plain words here token = "{k}" and so on, see part {n}') for n, k in enumerate(keys)]
    rows += [(100, 'config: token="short-7" end'), (101, 'a token: "nothing here" and "more" text'),
             (102, f"a build of {key(40)} without a cue"), (103, 'a token = "withoutdigits" here'),
             (104, f'the token = "{"ab1" * 40}" is long'), (105, f'{"w" * 400} token = "xy77z"'),
             (106, "plain prose: something with 1234 words"), (107, 'the token = DE89 3704 0044 0532 0130 00, and 77 more')]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    found = {i: [t[int(s):int(e)] for _, s, e in (x.split(":") for x in spans[i].split(",") if x)] for i, t in rows}
    assert [found[n] for n in range(30)] == [[k] for k in keys]
    # the label holds without spaces too only if it was taught that way; a bare key is no span
    assert found[102] == found[106] == found[101] == []
    assert found[100] == ["short-7"] and found[103] == ["withoutdigits"] and found[104] == ["ab1" * 40]
    assert found[105] == ["xy77z"] and found[107] == ["DE89 3704 0044 0532 0130 00"]
    clean = {r.doc_id: r.text for r in pii.without_pii(docs).collect()}
    assert clean[107] == "the token = [ID], and 77 more" and clean[0] == 'plain words here token = "[ID]" and so on, see part 0'


def test_counts_of_contexts_against_brute_force(spark):
    random.seed(12)
    bits = ["key", "key:", "key =", '"v7"', "Key=v8", "# 12", "x_y:(z9", "é:", "1.2.3.4", "\n", "word", "a:b:1234", "::", "'", "\t"]
    texts = ["".join(random.choice(bits) + random.choice(["", " ", "  "]) for _ in range(12)) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts + ["", None]], "text string")
    want = {}
    for text in texts:
        listed = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
        names = [f"{a} {b}" for a, b in zip(listed, listed[1:-1])]
        for m in re.finditer(r"(?<![^\W])(\w+)([=:#\x20\t\"'(<\[]+)(?=[^\x20\x09-\x0D=:#\"'(<\[])", text):
            if re.search("[=:#]", m[2]):
                names.append(m[1].lower() + re.sub("[ \t]", "", m[2]))
        for name in names:
            want[pii.pattern_hash(name)] = want.get(pii.pattern_hash(name), 0) + 1
    patterns = spark.createDataFrame([(h,) for h in want], "h long")
    assert {r.h: r.total for r in pii.corpus_counts(docs, patterns).collect()} == want
    for text in texts:  # every context of a candidate is one that the texts are counted for
        assert {h for *_, h in pii.occurrences(text, pii.base_spans(text))} <= set(want)


def test_planted_keys_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    planted = {i for i, t in texts.items() if re.search(r'token = "[0-9a-f]{40}"', t)}
    rows = {r.doc_id: r for r in op4_pii(spark, folder).collect()}
    found = {i for i, r in rows.items() if r.n_id}
    assert len(planted) >= 8 and found == planted  # recall and precision 1 on the planted cue
    for i in planted:
        spans = [x.split(":") for x in rows[i].spans.split(",") if x.startswith("id:")]
        assert all(re.fullmatch("[0-9a-f]{40}", texts[i][int(s):int(e)]) for _, s, e in spans)
