import random

from fluelake.llm import scans as N

SENTENCES = [
    "The permittee shall maintain records of fuel consumption for five years at the dock area.", "Visible emissions from the crude storage tank shall not exceed ten percent opacity.",
    "No later than May the permittee shall install a gas-fired low-emission burner on the rotary kiln.", "The public comment period closed and comments were received by the department.",
    "Idle hours of the baghouse are not counted, provided that the damper remains sealed.", "During the shift the cyclone operated below its required temperature for some minutes.",
]


def page(lines, head, n, total):
    return ([head] if head and n > 1 else []) + lines + [f"Page {n} of {total}"]


def scanned(rng, width=60):
    """A text of two pages with its true noise."""
    lines, noise = [], []
    words = " ".join(rng.choice(SENTENCES) for _ in range(14)).split(" ")
    body, cur = [], ""
    for w in words:
        if cur and len(cur) + 1 + len(w) > width:
            if len(w) > 7 and "-" not in w and rng.random() < 0.4:
                body.append((cur + " " + w[:4] + "-", "hyphen"))
                cur = w[4:]
            else:
                body.append((cur, None))
                cur = w
        else:
            cur = f"{cur} {w}" if cur else w
    body.append((cur, None))
    half = len(body) // 2
    for n, part in ((1, body[:half]), (2, body[half:])):
        if n == 1:
            lines += ["TX Division of Air Quality", "Operating permit for Redwater Mill", ""]
        else:
            lines += ["", "--- Page Break ---", "", "Redwater Mill    2"]
            noise.append((len(lines), "running"))
        for s, k in part:
            wrong = rng.random() < 0.04
            if wrong:
                for a, b in (("permittee", "perrnittee"), ("emissions", "ernissions"), ("temperature", "ternperature"), ("received", "receivcd"), ("damper", "clamper"), ("shall", "shal|")):
                    if a in s and not s.endswith(a[:4] + "-"):
                        s = s.replace(a, b, 1)
                        noise.append((len(lines) + 1, "ocr"))
                        break
            lines.append(s)
            if k:
                noise.append((len(lines), k))
        lines.append(f"Page {n} of 2")
        noise.append((len(lines), "running"))
    return "\n".join(lines), set(noise)


def test_page_numbers():
    for s in ("3", "- 12 -", "[4]", "Pg. 2/7", "1 | Page", "Page 2 of 9", "pagc 3", "[l]"):
        assert N.is_page_number(s), s
    for s in ("Page 33 of the application lists points.", "2.15 Emission limits", "rotary kiln    37    Subpart LLL", "7 evenings.", "year."):
        assert not N.is_page_number(s), s


def test_planted_noise(spark):
    rng = random.Random(6)
    texts = [scanned(rng) for _ in range(60)]
    d = spark.createDataFrame([(i, "tx_1_doc", t) for i, (t, _) in enumerate(texts)], "text_id long, filename string, source string")
    got = {(r.id, r.line_no, r.noise) for r in N.found(d).collect()}
    want = {(i, *x) for i, (_, n) in enumerate(texts) for x in n}
    assert len(got & want) / len(want) > 0.95, sorted((x, texts[x[0]][0].split("\n")[x[1] - 1]) for x in want - got)[:12]
    assert len(got & want) / len(got) > 0.95
    out = N.repaired(d.limit(5)).collect()
    for r in out:
        assert "Page 1 of 2" not in r.repaired and "Page Break" not in r.repaired


def test_edges(spark):
    d = spark.createDataFrame([(1, None, None), (2, "f", ""), (3, "f", " \n "), (4, "f", "One sound line."), (4, "f", "One sound line."), (5, "f", "long " * 20_000)], "text_id long, filename string, source string")
    assert N.found(d).count() == 0
    got = {r.id: r.repaired for r in N.repaired(d).collect()}
    assert got[1] is None and got[2] == "" and got[4] == "One sound line."
    assert N.found(d.limit(0)).count() == 0 and N.repaired(d.limit(0)).count() == 0
    assert N.found(d.selectExpr("*", "1 as id", "2 as text", "3 as words")).count() == 0


def test_missing_page_breaks(spark):
    rng = random.Random(8)
    plain = lambda: [rng.choice(SENTENCES)[:60].rsplit(" ", 1)[0] for _ in range(20)]
    texts = []
    for style in ("Pg. {}/4", "Page {} of 4", "{} | Page", "- {} -", "{}"):
        lines, want = [], set()
        for n in range(1, 5):
            if n > 1:
                lines.append(f"{n}    TX-3623874-01")
                want.add(len(lines))
            lines += ["TX Division of Air Quality", "Permit TX-3623874-01", *plain()] if n == 1 else plain()
            lines.append(style.format(n))
            want.add(len(lines))
        texts.append(("\n".join(lines), want))
    # heads that hold the number, and no foot
    heads = [[f"Permit TX-3623874-01    Page {n} of 4", *plain()] for n in (2, 3, 4)]
    texts.append(("\n".join(["TX Division of Air Quality", "Permit TX-3623874-01", *plain(), *[x for h in heads for x in h]]), {23, 44, 65}))
    # numbers that are data: no sequence with room for pages
    texts.append(("\n".join(x for v in (12, 11, 40, 3, 2, 7, 1, 9) for x in (*plain()[:3], str(v))), {32}))
    d = spark.createDataFrame([(i, "tx_1_doc", t) for i, (t, _) in enumerate(texts)], "text_id long, filename string, source string")
    got = {(r.id, r.line_no) for r in N.found(d).where("noise = 'running'").collect()}
    assert got == {(i, n) for i, (_, want) in enumerate(texts) for n in want}
    for r in N.repaired(d.where("text_id < 5")).collect():
        assert not any(f"{n}    TX-3623874-01" in r.repaired or texts[r.id][0].split("\n")[-1].replace("4", str(n), 1) in r.repaired.split("\n") for n in (2, 3))


def test_misreadings_at_every_size(spark):
    one = ["The final report shall be sent."] * 62 + ["The final rport shall be sent."] + ["Each water tube boiler runs."] * 2 + ["Each water the boiler runs."] + ["The boiler runs."] * 150
    for copies in (1, 10):
        d = spark.createDataFrame([(i, "tx_1_doc", t) for i, t in enumerate(one * copies)], "text_id long, filename string, source string")
        got = sorted(r.id for r in N.found(d).where("noise = 'ocr'").collect())
        assert got == [62 + k * len(one) for k in range(copies)]


def test_heads_of_any_height_and_page_number_last():
    head = ["Alder Ridge Works", "Title V Operating Permit", "Permit No. VA-3623874-01", "Draft Statement of Basis", "Page 2 of 3"]
    text = ["ALDER RIDGE WORKS", "Permit VA-3623874-01", "", "The owner shall keep records of each inspection."]
    text += ["--- Page Break ---", *head, "The second page begins in the middle of a sentence here."]
    at = text.index(head[0])
    assert N.furniture(text, "x.pdf") == set(range(at, at + len(head)))


def test_forms_as_expression(spark):
    from pyspark.sql import functions as F

    words = ["modern", "rn", "c1ean", "hill", "|nlet", "wwm", "50x0", "straße"]
    d = spark.createDataFrame([(w,) for w in words], "w string").select("w", N._formed(F.col("w")).alias("f"))
    assert {r.w: r.f for r in d.collect()} == {w: N.form(w) for w in words}
