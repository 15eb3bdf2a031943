import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = collections.Counter(windows)
    inside = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def check(docs):
    got = quality.judge(docs, ["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    for r in got:
        n, _, _, _, repeated = want = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n) and not (r.kept and r.base_failed)


def test_whole_table(small):
    check(small)


def test_edges_and_empty(edge_docs, no_docs):
    check(edge_docs)
    assert quality.judge(no_docs, ["doc_id"]).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab \n\t#é"), max_size=120))
def test_counts(text):
    assert quality.base_counts(text.encode()) == brute(text)


def test_good_labels_are_kept(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = quality.judge(small, ["doc_id"]).join(labels, "doc_id").where("not base_failed")
    assert got.where("quality = 1 and not kept").count() == 0


def test_bands():
    import zstandard
    codec, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    judge = lambda t: quality.compression(t, bands, codec)[2]
    assert not judge(b"spam spam " * 500)
    import numpy as np
    assert not judge(np.random.default_rng(0).bytes(20_000))
    assert judge(b"") and judge(b"short")
    import random
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice(["an", "er", "th", "on", "re", "st"]) for _ in range(rng.randrange(1, 5))) for _ in range(n)).encode()
    assert judge(prose(200)) and judge(prose(5000))
    # half of the text is one line again and again
    assert not judge(prose(1500) + b"buy now buy now buy now " * 600)


def test_incompressible_text_alone_and_inside_prose():
    import base64
    import random

    import numpy as np
    import zstandard
    codec, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    judge = lambda t: quality.compression(t, bands, codec)
    rng, pick = np.random.default_rng(5), random.Random(6)
    noise = {"base64": lambda n: base64.b64encode(rng.bytes(n))[:n], "printable": lambda n: bytes(rng.integers(33, 127, n, dtype=np.uint8))}
    words = ["".join(pick.choice(["an", "er", "th", "on", "re", "st"]) for _ in range(pick.randrange(1, 5))) for _ in range(3000)]
    prose = lambda n: " ".join(words[int(3000 * pick.random() ** 3)] for _ in range(n)).encode()[:n]
    for kind, make in noise.items():
        for n in (120, 149, 150, 199, 200, 299, 300, 599, 600, 999, 1000, 2999, 3000, 4096, 9999, 10_000, 60_000):
            assert not judge(make(n))[2], (kind, n)
        # half of the document, and a last chunk that is not full
        assert not judge(prose(5_000) + make(10_000) + prose(5_000))[2], kind
        assert judge(prose(4096) + make(3000))[1:] == (3000 / 7096, False), kind
        # a short rest weighs by its bytes
        assert judge(prose(8192) + make(300))[1:] == (300 / 8492, True), kind
    for n in (100, 120, 200, 300, 1000, 4096, 5000, 20_000, 60_000):
        assert judge(prose(n))[1:] == (0.0, True), n


#: the first article and preamble lines of the declaration of human rights
SCRIPTS = {
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。鉴于对人类家庭所有成员的固有尊严及其平等的和不移的权利的承认，"
          "乃是世界自由、正义与和平的基础，鉴于对人权的无视和侮蔑已发展为野蛮暴行，这些暴行玷污了人类的良心，而一个人人享有言论和信仰自由并免予恐惧和匮乏的世界的来临，"
          "已被宣布为普通人民的最高愿望，鉴于为使人类不致迫不得已铤而走险对暴政和压迫进行反叛，有必要使人权受法治的保护。",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。"
          "人類社会のすべての構成員の固有の尊厳と平等で譲ることのできない権利とを承認することは、世界における自由、正義及び平和の基礎である。",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. "
          "Принимая во внимание, что признание достоинства, присущего всем членам человеческой семьи, и равных и неотъемлемых прав их является основой свободы, справедливости и всеобщего мира.",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق، وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء. "
          "لما كان الاعتراف بالكرامة المتأصلة في جميع أعضاء الأسرة البشرية وبحقوقهم المتساوية الثابتة هو أساس الحرية والعدل والسلام في العالم.",
}


def cut(text, size):
    """The first characters of a text, of at most ``size`` bytes."""
    return text.encode()[:size].decode("utf-8", "ignore").encode()


def test_prose_of_other_scripts_stays():
    """Whole paragraphs and their beginnings; longer texts made of their words."""
    import random

    import zstandard
    codec, bands, rng = zstandard.ZstdCompressor(level=3), quality.Bands(), random.Random(4)
    for lang, text in SCRIPTS.items():
        for size in range(120, len(text.encode()), 15):
            assert quality.compression(cut(text, size), bands, codec)[2], (lang, size)
        # longer texts: words of pieces of the text, as many different ones as prose has
        letters = text.replace(" ", "")
        words = ["".join(letters[i:i + 2] for i in rng.choices(range(len(letters) - 1), k=rng.randrange(1, 4))) for _ in range(4000)]
        weight = [1 / (i + 3) for i in range(len(words))]
        joint = " " if " " in text else ""
        for size in (1_500, 4_000, 12_000, 60_000):
            made = joint.join(rng.choices(words, weight, k=size))
            assert quality.compression(cut(made, size), bands, codec)[2], (lang, size)


def test_random_text_goes_whatever_stands_around_it():
    import base64

    import zstandard
    codec, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    import numpy as np
    noise = np.random.default_rng(3).bytes(30_000)
    for size in (150, 400, 1_500, 5_000, 30_000):
        assert not quality.compression(base64.b64encode(noise)[:size], bands, codec)[2], size
    half = (SCRIPTS["zh"] * 3).encode()[:4096 // 3 * 3] + b"." + base64.b64encode(noise)[:16_384]
    assert not quality.compression(half, bands, codec)[2]


def plain_verdict(text):
    """``kept`` written out by itself."""
    import zstandard

    def packed(x):
        return len(zstandard.ZstdCompressor(level=3).compress(x)) / len(x)

    def top(x, latin):
        per = len(x) / len(x.decode("utf-8", "replace")) if x else 1
        if per >= 2.2:
            return 9 if len(x) < 600 else 0.97 if len(x) < 3000 else 0.90 if len(x) < 10_000 else 0.85
        if per >= 1.15:
            return 9 if len(x) < 300 else 0.93 if len(x) < 1000 else 0.84 if len(x) < 3000 else 0.77
        return latin

    n, _, _, _, repeated = brute(text)
    if n < 10 or 100 * repeated > 20 * n:
        return False
    raw = (text or "").encode()
    steps = [(100, .40, 9), (120, .40, .975), (150, .40, .925), (200, .40, .88), (300, .38, .80), (600, .38, .73), (1000, .34, .68),
             (3000, .30, .63), (10_000, .26, .60), (50_000, .22, .58)]
    of = lambda x: [(lo, hi) for size, lo, hi in steps if len(x) >= size][-1:]
    judged = bad = 0
    for i in range(0, len(raw), 4096):
        x = raw[i:i + 4096]
        hi = top(x, 0.65) if len(x) == 4096 else top(x, of(x)[0][1]) if of(x) else None
        if hi is not None:
            judged += len(x)
            bad += len(x) if not 0.15 <= packed(x) <= hi else 0
    if judged and bad / judged > 0.25:
        return False
    return not of(raw) or of(raw)[0][0] <= packed(raw) <= top(raw, of(raw)[0][1])


def test_verdicts_against_a_plain_form(small):
    got = quality.judge(small, ["doc_id", "text"]).collect()
    assert [r.doc_id for r in got if r.kept != plain_verdict(r.text)] == []
    assert 0 < sum(r.kept for r in got) < len(got)
