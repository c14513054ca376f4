import re

import numpy as np
import pytest

from sharedsignal.llm import fmindex as X
from sharedsignal.llm import licenses as L
from sharedsignal.llm.common import ascii_word_table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text):
    return WORD.findall((text or "").encode().translate(LOW))


def test_word_table():
    text = "A-b Çé_9日 x\x00y\x7fz " + "".join(map(chr, range(128)))
    assert text.encode().translate(ascii_word_table()).split() == words(text)


def test_fm_index(rng):
    for _ in range(20):
        n, vocabulary = int(rng.integers(1, 400)), int(rng.integers(1, 6))
        text = rng.integers(0, vocabulary + 1, n + 2)
        text[0] = text[-1] = 0
        index = X.FMIndex(text)
        for m in (1, 2, 4):
            windows = rng.integers(1, vocabulary + 3, (30, m))
            lo, hi = index.search(windows)
            for w, a, b in zip(windows, lo, hi):
                want = [p for p in range(len(text) - m + 1) if (text[p:p + m] == w).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def slow_scan(rows, items, width):
    windows = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add(name)
    out = []
    for i, text in rows:
        w = words(text)
        hit, names = np.zeros(len(w), bool), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found:
                    hit[k:k + n] = True
                    names |= found
        out.append((i, len(w), int(hit.sum()), sorted(names)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [X.BLOCK_BYTES, 40])
def test_scan_equals_brute_force(spark, rng, block):
    vocabulary = [f"w{k}" for k in range(9)] + ["É", "日"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(rng.integers(1, 9))) for k in range(12)] + [(50, None), (51, "..."), (52, text(2))]
    rows = [(k, (text(rng.integers(0, 60)) + ". " + str(items[k % 12][1]) + "!").upper()) for k in range(40)] + [(90, None), (91, "")]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r._report.n_words, sum(s["last"] - s["first"] for s in r._report.spans), list(r._report["items"]))
           for r in X.scan(docs, bench, width=4, block_bytes=block, shard_bytes=300).collect()]
    assert sorted(got, key=str) == slow_scan(rows, [(str(a), b) for a, b in items], 4)


def test_decontaminate(spark, hostile, nothing):
    bench = spark.createDataFrame([(1, "cat sat on the MAT and the dog ran to"), (2, None)], "item_id bigint, text string")
    out = X.decontaminate(hostile, bench)
    assert out.columns == hostile.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "The  the park." and got[1].n_chars == 14 and got[2].text is None and got[3].text == ""
    assert X.decontaminate(nothing, bench).count() == 0
    assert X.decontaminate(hostile, bench.limit(0)).count() == 9


def test_suffix_automaton(rng):
    for _ in range(20):
        seqs = [rng.integers(1, 4, rng.integers(1, 12)).tolist() for _ in range(4)]
        whole = [0, 1]
        a = L.SuffixAutomaton(seqs, whole)
        text = rng.integers(0, 4, 60).tolist()
        for i, (v, n) in enumerate(a.stream(text)):
            longest = max(m for m in range(i + 2) if m == 0 or any(
                s[k:k + m] == text[i + 1 - m:i + 1] for s in seqs for k in range(len(s) - m + 1)))
            assert n == longest
            if n:
                ends = {k: min(e for e in range(n, len(s) + 1) if s[e - n:e] == text[i + 1 - n:i + 1])
                        for k, s in enumerate(seqs) if any(s[e - n:e] == text[i + 1 - n:i + 1] for e in range(n, len(s) + 1))}
                assert ends == a.ends[v]
                assert {k for m, k in a.complete[v] if m <= n} == {k for k in whole if len(seqs[k]) <= i + 1 and text[i + 1 - len(seqs[k]):i + 1] == seqs[k]}


def test_license_scan(spark, hostile, nothing):
    mit = L.NOTICES[0][0]
    texts = ["Released under the MIT License.", "the mit, license; MIT-License apache  license (GENERAL public license)",
             "Foo " + mit.replace("copy", "copy!", 1).upper() + " bar", mit[:200], "Licensed under CC BY-NC 4.0.", "mitlicense mit licenses"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r._report for r in L.scan(df).collect()}
    for k, t in enumerate(texts):
        w = words(t)
        want = sorted((p, label) for phrase, label in L.PHRASES for p in range(len(w))
                      if w[p:p + len(phrase.split())] == [x.encode() for x in phrase.split()])
        assert [(p.start, p.label) for p in got[k].places] == want and got[k].n_words == len(w)
    assert [(s.label, s.first) for s in got[2].spans if s.label] == [("mit", 1)] and got[2].spans[0].covered == 1.0
    assert [s.label for s in got[4].spans] == ["cc-by-nc"] and not [s for s in got[3].spans if s.label] and 0 < got[3].spans[0].covered < 1
    assert L.scan(hostile).count() == 9 and L.scan(nothing).count() == 0


def test_later_paragraphs_of_licences(spark):
    texts = [("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
              "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
              "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
              "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
             ("bsd", "* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
              "disclaimer in the documentation and/or other materials provided with the distribution."),
             ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
              "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
             ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
              "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")]
    texts += [(label, t.splitlines()[-1]) for t, label in L.NOTICES if "\n" in t]
    texts += [(label, t.splitlines()[t.count("\n") // 2]) for t, label in L.NOTICES if t.count("\n") > 5]
    df = spark.createDataFrame([(k, "Some words. " + t + " And more.") for k, (_, t) in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r._report.spans for r in L.scan(df).collect()}
    for k, (label, t) in enumerate(texts):
        assert label in {s.label for s in got[k]} and all(s.covered < 1 for s in got[k]), (k, label, t[:60])
    assert [{s.label for s in got[k]} - {None} for k in (0, 1)] == [{"mit"}, {"bsd"}]
    first = L.NOTICES[0][0].split("\n")[0]
    alone = L.scan(spark.createDataFrame([(1, first)], "doc_id bigint, text string")).first()._report.spans[0]
    assert alone.label == "mit" and alone.covered == len(first.split()) / len(L.NOTICES[0][0].split())


def test_paragraph_sweep_equals_all_pairs(rng):
    for _ in range(300):
        labels = [f"l{k % 4}" for k in range(8)]
        found = []
        for _ in range(int(rng.integers(0, 25))):
            a = int(rng.integers(0, 12))
            found.append((int(rng.integers(0, 8)), a, a + int(rng.integers(1, 8)), float(rng.integers(1, 5))))
        want = [x for x in found if not any(y[1] <= x[1] and x[2] <= y[2] and y[3] > x[3] and labels[y[0]] != labels[x[0]] for y in found)]
        assert L.best_paragraphs(found, labels) == want
        inside = L.Inside([x[:3] for x in found])
        for k in range(8):
            for a in range(13):
                for z in range(a, 20):
                    assert inside.has(k, a, z) == any(x[0] == k and a <= x[1] and x[2] <= z for x in found)


def test_thousands_of_notices_in_one_text(spark):
    import time
    line = "Released under the MIT license. Some other words stand here between two of them. Licensed under CC BY-NC 4.0.\n"
    few, many = (spark.createDataFrame([(1, line * n)], "doc_id bigint, text string") for n in (100, 25_000))
    each = [s.label for s in L.scan(few).first()._report.spans]
    assert each.count("mit") == each.count("cc-by-nc") == 100
    start = time.time()
    labels = [s.label for s in L.scan(many).first()._report.spans]
    assert labels.count("mit") == labels.count("cc-by-nc") == 25_000 and len(labels) == 250 * len(each)
    assert time.time() - start < 120  # all pairs of 50,000 chains took many times this
