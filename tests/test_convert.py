import base64
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from docengine import api
from docengine.operators import assets, merge, passes
from docengine.operators import convert as C
from docengine.operators.options import build_options
from docengine.plans.catalog import docx_of, pdf_of
from docengine.sources import documents, formats, sink
from docengine.streaming import folder


class Counting:
    def __init__(self, *errors):
        self.errors = list(errors)
        self.calls = []

    def convert(self, content, suffix, options, device):
        self.calls.append((dict(options), device))
        if self.errors:
            raise self.errors.pop(0)
        return {"text": "ok", "warnings": ["own"]}


def test_ladder():
    b = Counting(RuntimeError("CUDA out of memory. Tried"))
    got = C.climb(b, b"", ".pdf", {})
    assert got["text"] == "ok" and got["warnings"] == [C.MEMORY_WARNING, "own"] and b.calls[1][1] == "cpu"
    b = Counting(RuntimeError("LLM service unavailable"))
    got = C.climb(b, b"", ".pdf", {"use_llm": True, "ollama_model": "m", "llm_service": "ollama", "page_range": "1"})
    assert got["warnings"][0] == C.LLM_WARNING and b.calls[1][0] == {"page_range": "1"}
    b = Counting(RuntimeError("hip out of memory"), RuntimeError("gemini"), RuntimeError("cuda out of memory"))
    assert C.climb(b, b"", ".pdf", {"use_llm": True})["error"].startswith("RuntimeError: cuda")
    assert "error" in C.climb(Counting(RuntimeError("LLM")), b"", ".pdf", {})


def test_pdf():
    assert formats.pdf_page_count(pdf_of(["Hello World"])) == 1
    assert formats.parse_pdf(pdf_of(["Hello (World)\\", "two"], packed=True)) == [[("paragraph", 0, "Hello (World)\\")], [("paragraph", 0, "two")]]
    with pytest.raises(formats.UnsupportedDocument):
        formats.pdf_page_count(b"no")


def test_office_and_epub():
    assert formats.parse(docx_of(["One & two", "three"]), ".docx")[0] == [[("paragraph", 0, "One & two"), ("paragraph", 0, "three")]]
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("META-INF/container.xml", '<c><rootfiles><rootfile full-path="o/p.opf"/></rootfiles></c>')
        z.writestr("o/p.opf", '<p xmlns:dc="d"><metadata><dc:title>T</dc:title></metadata><manifest><item id="a" href="a.html"/></manifest><spine><itemref idref="a"/></spine></p>')
        z.writestr("o/a.html", "<h2>Head</h2><p>Text")
    assert formats.parse(box.getvalue(), ".epub") == ([[("heading", 2, "Head"), ("paragraph", 0, "Text")]], {"title": "T"})
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<s><si><t>a</t></si></s>")
        for n in (2, 10, 1):
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'<w><row><c t="s"><v>0</v></c><c><v>{n}</v></c></row></w>')
    assert [p[0][2] for p in formats.parse(box.getvalue(), ".xlsx")[0]] == ["a | 1", "a | 2", "a | 10"]
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("ppt/slides/slide1.xml", '<s><sp><ph type="title"/><p><r><t>Head</t></r></p></sp><sp><p><t>Body</t></p></sp></s>')
    assert formats.parse(box.getvalue(), ".pptx")[0] == [[("heading", 1, "Head"), ("paragraph", 0, "Body")]]


def test_html_renderers():
    content = b"<title>T</title><nav>no</nav><h1>A &amp; b</h1><p>x <b>y</b><br>z<ul><li>i</ul><pre>c  d</pre><img src='p/q.png'><table><tr><td>1<td>2</table>"
    pages, meta = formats.parse(content, ".html")
    assert meta == {"title": "T"}
    shown = list(enumerate(pages))
    assert formats.render(shown, "markdown", False) == "# A & b\n\nx **y**\nz\n\n- i\n\n```\nc  d\n```\n\n![](p/q.png)\n\n| 1 | 2 |"
    assert "<h1>A &amp; b</h1>" in formats.render(shown, "html", False)
    assert json.loads(formats.render(shown, "json", False))["children"][0]["children"][0]["text"] == "A & b"
    assert len(json.loads(formats.render(shown, "chunks", False))) == 6
    assert formats.render(shown, "markdown", True).startswith("\n\n{0}---")
    with pytest.raises(ValueError):
        formats.render(shown, "yaml", False)


def test_documents_by_chunks(spark):
    rows = [(1, "a.pdf", pdf_of([f"p{i}" for i in range(5)])), (2, "b.html", b"<p>x</p>"), (3, "c.pdf", b"broken"), (4, "d.png", b"\x89PNG"), (5, "e.pdf", None), (6, "f.pdf", pdf_of(["one"]))]
    docs = spark.createDataFrame(rows, "doc_id long, filename string, content binary")
    got = {r.doc_id: r for r in api.convert_result(docs, max_pages_per_chunk=2, use_llm=True).collect()}
    assert (got[1].text, got[1].page_count) == ("p0\n\np1\n\np2\n\np3\n\np4", 5)
    assert got[1].warnings == [C.NO_LLM] * 3
    assert got[2].warnings == [C.NO_LLM]
    assert got[2].text == "x" and got[6].text == "one" and got[6].warnings == [C.NO_LLM]
    assert all(got[i].text is None and got[i].error for i in (3, 4, 5))
    one = {r.doc_id: r.text for r in api.convert(docs, page_range="3,0-1", max_pages_per_chunk=2).collect()}
    assert one[1] == "p3\n\np0\n\np1"


def test_batch(spark):
    rows = [(0, "a.html", base64.b64encode(b"<p>x").decode()), (1, "b.html", "!!!not-valid-base64!!!"), (2, None, base64.b64encode(pdf_of(["t"])).decode()), (3, "d.html", None)]
    results, summary = api.batch(spark.createDataFrame(rows, "doc_pos int, filename string, content_base64 string"))
    got = results.orderBy("doc_pos").collect()
    assert [(r.filename, r.success, r.content) for r in got] == [("a.html", True, "x"), ("b.html", False, None), ("document.pdf", True, "t"), ("d.html", True, "")]
    assert got[1].error and tuple(summary.first()) == (4, 3, 1)
    empty = spark.createDataFrame([], "doc_pos int, filename string, content_base64 string")
    assert tuple(api.batch(empty)[1].first()) == (0, 0, 0)


def test_merge(spark):
    a = lambda n: {"filename": n, "path": None, "content_base64": "QQ==", "media_type": "image/png"}
    rows = [
        (1, 1, "b", 2, {"t": "2", "n": None}, ["w2"], json.dumps({"images": [a("2")], "o": {"y": 2}, "m": {"z": 1}, "n": None})),
        (1, 0, "a", 2, {"t": "1", "n": "x", "u": "v"}, ["w1"], json.dumps({"images": [a("1")], "files": [a("3")], "o": {"x": 1, "y": 1}, "m": [1], "n": 1})),
        (1, 2, None, None, None, None, None),
        (2, 0, "", None, {}, [], "{}"),
    ]
    chunks = spark.createDataFrame(rows, merge.CHUNK.replace(merge.GROUPS, "string")).withColumn("assets", merge.groups_of(F.col("assets")))
    merged = merge.merge_chunks(chunks)
    got = {r.doc_id: r for r in merged.withColumn("assets", F.to_json("assets")).collect()}
    assert (got[1].text, got[1].page_count, got[1].metadata, got[1].warnings) == ("a\n\nb", 4, {"t": "2", "n": None, "u": "v"}, ["w1", "w2"])
    folded = json.loads(got[1].assets)
    assert [x["filename"] for x in folded["images"]] == ["1", "2"] and len(folded["files"]) == 1
    assert (folded["o"], folded["m"], folded["n"]) == ({"x": 1, "y": 2}, {"z": 1}, None)
    assert (got[2].text, got[2].page_count) == ("", None)
    assert {(r.asset_group, r.pos, r.filename) for r in assets.asset_rows(merged).collect()} == {("images", 0, "1"), ("images", 1, "2"), ("files", 0, "3")}


def test_files_in_and_out(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/sub/a.html").write_bytes(b"<p>hello")
    (tmp_path / "in/b.bin").write_bytes(b"x")
    got = api.convert_path(spark, str(tmp_path / "in"), "*.html")
    assert documents.write_texts(got, str(tmp_path / "out")) == 1
    assert (tmp_path / "out/sub/a.md").read_text() == "hello"
    one = lambda name: spark.createDataFrame([("c.pdf", "t", json.dumps({"images": [{"filename": name, "content_base64": "QUI="}]}))], "filename string, text string, assets string").withColumn("assets", merge.groups_of(F.col("assets")))
    assert documents.write_texts(one("img/x.png"), str(tmp_path / "out")) == 2
    assert (tmp_path / "out/c/img/x.png").read_bytes() == b"AB"
    with pytest.raises(Exception, match="leads out"):
        documents.write_texts(one("../x.png"), str(tmp_path / "none"))
    assert not any(files for _, _, files in os.walk(tmp_path / "none"))
    (tmp_path / "env").write_text("# no\n\nA = 'b=c'\nnothing\nX=\"y\"\n")
    assert sorted(map(tuple, documents.read_settings(spark, str(tmp_path / "env")).collect())) == [("A", "b=c"), ("X", "y")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.html").write_bytes(b"<p>one")
    rows = folder.convert_stream(folder.stream_folder(spark, str(tmp_path / "in")), build_options())
    assert rows.isStreaming
    for n in ("a", "b"):
        (tmp_path / f"in/{n}.html").write_bytes(b"<p>one")
        folder.start(rows, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["one", "one"]


def test_status_and_sql(spark):
    assert tuple(api.status(spark).first())[:2] == (True, "ready")
    assert tuple(api.status(spark, Counting(RuntimeError("x"))).first())[:2] == (False, "failed")
    with pytest.raises(RuntimeError):
        api.require_ready(spark, Counting(RuntimeError("x")))
    api.register(spark)
    assert [tuple(r) for r in spark.sql("select * from plan_chunks(9, 4)").collect()] == [(0, "0-3"), (1, "4-7"), (2, "8-8")]
    assert spark.sql("select * from plan_chunks(0, 4)").collect() == []
    o = spark.range(1).select(F.lit(b"<p>q").alias("c"), build_options().alias("o"))
    o.createOrReplaceTempView("one_doc")
    assert spark.sql("select convert_document(c, '.html', o).text from one_doc").first()[0] == "q"
    assert api.parser().parse_args(["a", "b"]).max_pages_per_chunk == 4


def test_bad_ranges_and_equal_ids_are_rows(spark):
    pdf = pdf_of(["a", "b", "c"])
    rows = [(1, "x.pdf", pdf, "5-3"), (1, "y.pdf", pdf, "1"), (2, "z.pdf", pdf, None), (3, "w.pdf", pdf, "3--1"), (4, "v.pdf", pdf, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, filename string, content binary, asked string")
    got = {r.filename: r for r in C.convert_documents(docs, build_options(page_range=F.col("asked"), max_pages_per_chunk=2)).collect()}
    assert got["y.pdf"].text == "b" and got["z.pdf"].text == "a\n\nb\n\nc" and got["y.pdf"].doc_id == got["x.pdf"].doc_id == 1
    assert "greater than or equal" in got["x.pdf"].error and "non-negative" in got["w.pdf"].error and got["v.pdf"].error
    none = C.convert_documents(docs.where("doc_id < 3"), build_options(max_pages_per_chunk=0)).collect()
    assert all("greater than zero" in r.error for r in none) and len(none) == 3


def test_texts_are_never_lost(spark, tmp_path):
    for n in ("a/r.html", "b/r.html"):
        (tmp_path / "in" / n).parent.mkdir(parents=True)
        (tmp_path / "in" / n).write_text(f"<p>{n}")
    got = api.convert_path(spark, str(tmp_path / "in"))
    assert documents.write_texts(got, str(tmp_path / "out")) == 2
    assert [(tmp_path / "out" / n / "r.md").read_text() for n in "ab"] == ["a/r.html", "b/r.html"]
    (tmp_path / "in/b/r.txt").write_text("other")
    with pytest.raises(Exception, match="two files"):
        documents.write_texts(api.convert_path(spark, str(tmp_path / "in")), str(tmp_path / "none"))
    assert not any(files for _, _, files in os.walk(tmp_path / "none"))
    with pytest.raises(ValueError, match="two files"):
        sink.check_names(documents.read_files(spark, str(tmp_path / "in")))


def test_results_of_any_kind(spark):
    png = b"\x89PNG\r\n"
    got = C.coerce_result({"text": "t", "extras": [{"fig.png": png, "pages": (1, 2)}, {"images": [{"filename": "b.png"}]}, None, "text"]})
    assert got["metadata"] == {"pages": [1, 2]} and got["assets"]["images"] == [{"filename": "b.png"}]
    assert C.coerce_result({"extras": [{"fig.png": png}]})["assets"]["images"][0]["media_type"] == "image/png"
    assert C.coerce_result({"extras": [{"x": [{"Path": "a"}]}]})["assets"] == {"x": [{"Path": "a"}]}
    docs = spark.createDataFrame([(1, "a.html", b"<title>T</title><p>x")], "doc_id long, filename string, content binary")
    assert json.loads(api.convert_json(docs).first()["result"])["metadata"] == {"title": "T"}


def test_one_backend_a_worker_and_a_last_try(spark):
    made = []

    class Own:
        def __init__(self, device, precision):
            made.append((device, precision))

        def convert(self, content, suffix, options, device):
            return {"text": f"{len(made)}"}

    b = C.PerWorker(Own, "cuda", "float16")
    assert [C.climb(b, b"", ".pdf", {})["text"] for _ in range(3)] == ["1"] * 3 and made == [("cuda", "float16")]
    oom = [RuntimeError("cuda out of memory")] * 2
    assert "error" in C.climb(Counting(*oom), b"", ".pdf", {}) and C.climb(Counting(*oom), b"", ".pdf", {}, again=True)["text"] == "ok"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_cut_documents_are_shuffled(spark):
    docs = spark.createDataFrame([(1, "a.html", b"<p>x"), (2, "b.pdf", pdf_of(["p"] * 9))], "doc_id long, filename string, content binary")
    whole = plan_of(api.convert_result(docs))
    assert "Exchange" not in whole and whole.count("ArrowEvalPython") == 1
    cut = plan_of(api.convert_result(docs, max_pages_per_chunk=2))
    assert "Union" in cut and "Exchange hashpartitioning" in cut


class Spy:
    """Tells how many bytes it got, and for which pages."""

    def convert(self, content, suffix, options, device):
        pages, _ = formats.parse(content, suffix)
        return {"text": f"{len(content)}:{options.get('page_numbers')}:{len(pages)}"}


def test_parts_hold_only_their_own_pages(spark):
    pdf = pdf_of([f"page {i} " + "x" * 2000 for i in range(40)])
    docs = spark.createDataFrame([(1, "a.pdf", pdf), (1, "a.pdf", pdf), (2, "a.pdf", pdf)], "doc_id long, filename string, content binary")
    got = api.convert_result(docs, backend=Spy(), max_pages_per_chunk=4).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.doc_id)] == [1, 1, 2]
    parts = [x.split(":") for x in got[0].text.split("\n\n")]
    assert [(n, k) for _, n, k in parts] == [(f"{i}-{i + 3}", "4") for i in range(0, 40, 4)]
    assert len(pdf) < sum(int(x) for x, _, _ in parts) < 1.2 * len(pdf)
    paged = api.convert_result(docs.where("doc_id = 2"), page_range="7,3-4,7", max_pages_per_chunk=3, paginate_output=True).first()
    assert [x.split("}")[0] for x in paged.text.split("{")[1:]] == ["7", "3", "4", "7"] and paged.page_count == 4


class Where:
    def convert(self, content, suffix, options, device):
        from pyspark import TaskContext

        return {"text": str(TaskContext.get().partitionId())}


def test_parts_of_one_document_keep_many_tasks_busy(spark):
    docs = spark.createDataFrame([(1, "a.pdf", pdf_of([f"p{i}" for i in range(400)]))], "doc_id long, filename string, content binary")
    got = api.convert_result(docs, backend=Where(), max_pages_per_chunk=4)
    assert len(set(got.first().text.split("\n\n"))) == 4
    assert plan_of(got).count("Exchange hashpartitioning") == 2
    whole = api.convert_result(docs, page_range="0-9,399").first().text
    assert api.convert_result(docs, page_range="0-9,399", max_pages_per_chunk=3).first().text == whole


def test_pages_past_the_end_are_told(spark):
    docs = spark.createDataFrame([(1, "a.pdf", pdf_of(["a", "b"])), (2, "b.html", b"<p>x")], "doc_id long, filename string, content binary")
    for size in (None, 1, 5):
        got = {r.doc_id: r for r in api.convert_result(docs, page_range="1-999999999999,7", max_pages_per_chunk=size).collect()}
        assert (got[1].text, got[1].page_count, got[1].warnings, got[1].error) == ("b", 1, [C.PAST_END], None), size
        assert (got[2].text, got[2].page_count, got[2].warnings) == ("", 0, [C.PAST_END])
    none = api.convert_result(docs.where("doc_id = 1"), page_range="7", max_pages_per_chunk=2).first()
    assert (none.text, none.page_count, none.warnings, none.error) == ("", 0, [C.PAST_END], None)


def packed_pdf():
    """Two pages inside an object stream, resources above them, and an object that nothing refers to."""
    import zlib

    body = b"<< /Type /Page /Parent 2 0 R >>  << /Type /Page /Parent 2 0 R /Contents 9 0 R >>"
    at = body.index(b"<<", 5)
    inner = f"5 0 6 {at} ".encode() + body
    first = inner.index(b"<<")
    packed = zlib.compress(inner)
    pdf = b"%PDF-1.5\n1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Type /Pages /Kids [5 0 R 6 0 R] /Resources 8 0 R >>\nendobj\n"
    pdf += f"4 0 obj\n<< /Type /ObjStm /N 2 /First {first} /Filter /FlateDecode /Length {len(packed)} >>\nstream\n".encode() + packed + b"\nendstream\nendobj\n"
    pdf += b"8 0 obj\n<< /Font 10 0 R >>\nendobj\n9 0 obj\n<< /Length 9 >>\nstream\n(hey) Tj \nendstream\nendobj\n10 0 obj\n<< /F1 1 >>\nendobj\n11 0 obj\n<< /Alone 1 >>\nendobj\n"
    return pdf


def test_parts_of_a_packed_pdf(spark):
    docs = spark.createDataFrame([(1, "a.pdf", packed_pdf())], "doc_id long, filename string, content binary")
    for size in (None, 1, 2):
        got = api.convert_result(docs, max_pages_per_chunk=size, paginate_output=True).first()
        assert (got.page_count, got.error) == (2, None) and got.text.replace("\n", "") == "{0}" + "-" * 48 + "{1}" + "-" * 48 + "hey", size


def test_pdf_outline_reaches_packed_and_inherited_objects():
    pdf = packed_pdf()
    got = formats.pdf_outline(pdf)
    assert got["total"] == 2 and got["top"] == 11
    texts = [b"".join(pdf[o["at"] : o["at"] + o["size"]] for o in (got["objects"][i] for i in p["needs"])) for p in got["pages"]]
    assert all(x in t for t in texts for x in (b"4 0 obj", b"2 0 obj", b"8 0 obj", b"10 0 obj")) and b"9 0 obj" in texts[1]
    assert not any(b"Alone" in t for t in texts) and b"9 0 obj" not in texts[0]


def test_what_a_pdf_hides_is_told(spark):
    hidden = pdf_of(["a"]).replace(b"trailer <<", b"trailer << /Encrypt 9 0 R")
    odd = pdf_of(["a"]).replace(b"<< /Length", b"<< /Filter /LZWDecode /Length")
    docs = spark.createDataFrame([(1, "a.pdf", hidden), (2, "b.pdf", odd)], "doc_id long, filename string, content binary")
    assert {r.doc_id: r.warnings for r in api.convert_result(docs).collect()} == {1: [formats.ENCRYPTED], 2: [formats.UNREAD]}


def test_names_of_outputs_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a.html", b"<p>x", "old", "more", 5)], "doc_id long, filename string, content binary, text string, error string, extra int")
    got = C.convert_documents(docs, build_options(), merged=False)
    assert got.columns == ["doc_id", "filename", *C.OUTPUTS, "extra"]
    assert (got.first().text, got.first().error, got.first().extra) == ("x", None, 5)


class FlakyOnce:
    """Out of memory unless on the CPU; the text tells the device."""

    def convert(self, content, suffix, options, device):
        if device != "cpu" and b"big" in content:
            raise RuntimeError("CUDA out of memory. Tried")
        if b"model" in content and options.get("use_llm"):
            raise ConnectionError("LLM service unavailable")
        return {"text": f"{device}:{sorted(options)}"}


def test_second_pass_sees_only_what_ran_out_of_memory(spark):
    rows = [(1, "a.html", b"small"), (2, "b.html", b"big"), (3, "c.html", b"big model"), (4, "d.html", None), (5, "e.html", b"model")]
    docs = spark.createDataFrame(rows, "doc_id long, filename string, content binary")
    o = build_options(use_llm=True)
    seen = []
    real = C._convert_stage
    C._convert_stage = lambda rows, backend, resources, *a: (seen.append((rows.count(), resources.device)), real(rows, backend, resources, *a))[1]
    try:
        got = C.convert_in_passes(docs, o, backend=FlakyOnce(), resources=passes.Resources("cuda", None, 1))
        got = {r.doc_id: r for r in got.select("doc_id", "text", "warnings", "error").collect()}
    finally:
        C._convert_stage = real
    plain = {r.doc_id: r for r in C.convert_documents(docs, o, backend=FlakyOnce()).select("doc_id", "text", "warnings", "error").collect()}
    assert got == plain and seen == [(5, "cuda"), (2, "cpu")]
    assert got[3].warnings == [C.MEMORY_WARNING, C.LLM_WARNING] and got[2].text.startswith("cpu")


class Told:
    def __init__(self, device, precision):
        self.told = f"{device}/{precision}"

    def convert(self, content, suffix, options, device):
        return {"text": self.told}


def test_settings_reach_the_backend_in_the_worker(spark):
    docs = spark.createDataFrame([(1, "a.html", b"x")], "doc_id long, filename string, content binary")
    try:
        spark.conf.set(passes.DEVICE_KEY, " AMD ")
        spark.conf.set(passes.PRECISION_KEY, "float16")
        spark.conf.set(passes.ACCELERATORS_KEY, "0.5")
        assert passes.session_resources(spark) == passes.Resources("cuda", "float16", 0.5, 1)
        backend = C.PerWorker.of_session(spark, Told)
        assert api.convert(docs, backend=backend).first().text == "cuda/float16"
        assert C.convert_in_passes(docs, build_options(), backend=backend).first().text == "cuda/float16"
        spark.conf.set(passes.PRECISION_KEY, "int8")
        with pytest.raises(ValueError, match="bfloat16, float16, float32"):
            C.PerWorker.of_session(spark, Told)
        spark.conf.set(passes.DEVICE_KEY, "directml")
        with pytest.raises(ValueError, match="amd, auto, cpu"):
            passes.session_resources(spark)
    finally:
        for k in (passes.DEVICE_KEY, passes.PRECISION_KEY, passes.ACCELERATORS_KEY):
            spark.conf.unset(k)


def test_profile_of_a_cluster_asks_for_accelerators(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context

    assert passes.Resources().profile(Session) is None
    tasks = passes.Resources("cuda", None, 0.25, 2).profile(Session).taskResources
    assert tasks["gpu"].amount == 0.25 and tasks["cpus"].amount == 2
    assert "gpu" not in passes.Resources("cuda", None, 0.25, 2).on_cpu().profile(Session).taskResources

    class Task:
        @staticmethod
        def get():
            class Given:
                addresses = ["3"]

            class Self:
                @staticmethod
                def resources():
                    return {"gpu": Given}

            return Self

    monkeypatch.setattr(passes, "TaskContext", Task)
    assert [passes.task_device(d) for d in (None, "cuda", "cpu", "mps")] == ["cuda:3", "cuda:3", "cpu", "mps"]


def test_batch_cuts_and_tries_again(spark):
    class Twice:
        """Runs out of memory twice, then works."""

        left = 2

        def convert(self, content, suffix, options, device):
            if self.left:
                self.left -= 1
                raise RuntimeError("cuda out of memory")
            return {"text": "ok"}

    one = spark.createDataFrame([(0, "a.html", base64.b64encode(b"x").decode())], "doc_pos int, filename string, content_base64 string").coalesce(1)
    assert api.batch(one, backend=Twice())[0].first().content == "ok"
    pdf = base64.b64encode(pdf_of(["a", "b", "c"])).decode()
    many = spark.createDataFrame([(0, "a.pdf", pdf)], "doc_pos int, filename string, content_base64 string")
    got = C.convert_batch(many, backend=Spy(), options=build_options(max_pages_per_chunk=1))[0].first()
    assert [x.split(":")[1:] for x in got.content.split("\n\n")] == [["0-0", "1"], ["1-1", "1"], ["2-2", "1"]] or [x.split(":")[1] for x in got.content.split("\n\n")] == ["0", "1", "2"]


def test_blocks_as_rows(spark):
    api.register(spark)
    spark.createDataFrame([(1, b"<h1>A</h1><p>b", "a.html"), (2, b"x", "b.xyz"), (3, None, "c.html")], "id long, content binary, name string").createOrReplaceTempView("some_docs")
    sql = "select d.id, b.* from some_docs d, lateral convert_blocks(d.content, d.name, '{}') b order by d.id, b.page"
    assert [tuple(r)[:6] for r in spark.sql(sql.format("chunks")).collect()][:2] == [(1, 0, 0, "heading", 1, "A"), (1, 0, 1, "paragraph", 0, "b")]
    got = spark.sql(sql.format("markdown"))
    assert got.columns == ["id", "page", "text", "error"] and got.first().text == "# A\n\nb"
    assert [r.error is None for r in got.collect()] == [True, False, False]
    with pytest.raises(Exception, match="output_format must be"):
        spark.sql(sql.format("yaml")).collect()


def test_command_line_converts_once_and_lists_errors(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.html").write_text("<p>one")
    (tmp_path / "in/b.xyz").write_text("two")
    (tmp_path / "env").write_text("OLLAMA_MODEL=m\nOTHER=x\n")
    assert api.main([str(tmp_path / "in"), str(tmp_path / "out"), "--no-paginate", "--settings", str(tmp_path / "env")]) == 0
    assert "b.xyz: UnsupportedDocument" in capsys.readouterr().out
    assert (tmp_path / "out/a.md").read_text() == "one"
    got = spark.range(1).select(api.settings_options(spark, str(tmp_path / "env")).alias("o")).first()["o"]
    assert got == {"llm_service": "ollama", "ollama_model": "m"}
    assert [r.filename for r in sink.read_errors(spark, str(tmp_path / "out")).collect()] == ["b.xyz"]
    assert not [x for x in os.listdir(tmp_path / "out") if x.startswith("_staging")]


def test_stream_of_chunks(spark, tmp_path):
    from docengine.streaming import merge as stream_merge

    spark.conf.set(stream_merge.STORE_KEY, stream_merge.STORE)
    kind = merge.CHUNK.replace(merge.GROUPS, "string") + ", n_chunks int"
    chunk = lambda d, k, n, **more: (d, k, f"t{d}{k}", 1, {"k": str(k)}, [f"w{k}"], json.dumps({"l": [k]}), n)
    first = [chunk(1, 1, 3), chunk(2, 0, 1), chunk(3, 0, 2)]
    second = [chunk(1, 0, 3), chunk(1, 1, 3), chunk(1, 2, 3)]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in (first, second):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        chunks = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
        chunks = chunks.withColumn("assets", merge.groups_of(F.col("assets")))
        got = stream_merge.merge_stream(chunks).withColumn("assets", F.to_json("assets"))
        query = got.writeStream.format("parquet").option("path", target).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(90)
    done = {r.doc_id: r for r in spark.read.parquet(target).collect()}
    batch = merge.merge_chunks(spark.createDataFrame([*first, *second][1:], kind).withColumn("assets", merge.groups_of(F.col("assets")))).withColumn("assets", F.to_json("assets"))
    want = {r.doc_id: r for r in batch.collect() if r.doc_id != 3}
    assert set(done) == {1, 2} and all(r.error is None for r in done.values())
    assert all(done[i].asDict() == want[i].asDict() | {"error": None} for i in want)


def test_missing_chunks_are_a_failed_row_in_time(spark, tmp_path):
    import time

    from docengine.streaming import merge as stream_merge

    spark.conf.set(stream_merge.STORE_KEY, stream_merge.STORE)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(3, 1, "t", 1, {}, [], "{}", 3)]
    spark.createDataFrame(rows, merge.CHUNK.replace(merge.GROUPS, "string") + ", n_chunks int").coalesce(1).write.parquet(source)
    chunks = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source).withColumn("assets", merge.groups_of(F.col("assets")))
    got = stream_merge.merge_stream(chunks, timeout_ms=500).drop("assets")
    query = got.writeStream.format("parquet").option("path", target).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        found, end = [], time.time() + 90
        while not found and time.time() < end and query.isActive:
            time.sleep(1)
            found = spark.read.schema(got.schema).parquet(target).collect() if os.path.isdir(os.path.join(target, "_spark_metadata")) else []
    finally:
        query.stop()
    assert [(r.doc_id, r.text, r.error) for r in found] == [(3, None, "missing chunks: 0,2")]


def test_running_summary_counts_a_repeated_file_once(spark, tmp_path):
    from docengine.streaming import merge as stream_merge

    source = str(tmp_path / "in")
    for n in range(2):
        spark.createDataFrame([("a", True), ("b", False), (f"c{n}", True)], "filename string, success boolean").coalesce(1).write.mode("append").parquet(source)
    rows = spark.readStream.schema("filename string, success boolean").parquet(source)
    query = stream_merge.running_summary(rows).writeStream.format("memory").queryName("sums").outputMode("complete").trigger(availableNow=True).start()
    assert query.awaitTermination(90)
    assert tuple(spark.sql("select * from sums").first()) == (4, 3, 1)


def test_listing_opens_no_file_and_sizes_reach_it(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>one")
    (tmp_path / "b.html").write_text("<p>" + "two" * 100)
    (tmp_path / "c.bin").write_text("x")
    listed = documents.read_files(spark, str(tmp_path), "*.html").select("filename", "length")
    os.chmod(tmp_path / "a.html", 0)
    assert sorted(map(tuple, listed.collect())) == [("a.html", 6), ("b.html", 303)]
    assert "ReadSchema: struct<path:string,length:bigint>" in plan_of(listed)
    small = documents.read_files(spark, str(tmp_path), "*.html", largest=100)
    assert "LessThanOrEqual(length,100)" in plan_of(small) and [r.filename for r in small.select("filename").collect()] == ["a.html"]
    with pytest.raises(ValueError, match="mounted"):
        sink.local_path("s3a://somewhere/x")


def test_results_of_a_batch_are_few_python_objects():
    import tracemalloc

    import pyarrow as pa

    class Long:
        def convert(self, content, suffix, given, device):
            return {"text": "x" * (1 << 20), "page_count": len(content)}

    n = 64
    contents = pa.array([None if k == 5 else bytes(1 << 20) for k in range(n)], pa.binary())
    suffixes, options = pa.array([".html"] * n), pa.array([{"extra": None}] * n, pa.struct([("extra", pa.map_(pa.string(), pa.string()))]))
    tracemalloc.start()
    got = C._convert_all(Long(), contents, suffixes, options, False)
    assert tracemalloc.get_traced_memory()[1] < 24 << 20
    tracemalloc.stop()
    assert [r["page_count"].as_py() for r in got] == [None if k == 5 else 1 << 20 for k in range(n)]
    assert got[5]["error"].as_py() == C.NO_CONTENT and len(C._convert_all(Long(), contents[:0], suffixes[:0], options[:0], False)) == 0


def test_outline_leaves_streams_packed(monkeypatch):
    pdf = pdf_of([f"page {k}" for k in range(40)], packed=True)
    made = []
    real = formats.zlib.decompressobj
    monkeypatch.setattr(formats.zlib, "decompressobj", lambda: made.append(1) or real())
    assert formats.pdf_outline(pdf)["total"] == formats.pdf_page_count(pdf) == 40 and not made
    assert [p[0][2] for p in formats.parse_pdf(pdf)] == [f"page {k}" for k in range(40)] and len(made) == 40


def test_objects_and_streams_end_where_their_marks_are():
    body = b"%PDF-1.4\n7 0 obj\n<< /K (xendobj) >>\nstream\r\nab\r\n\r\nendstream\nendobj\n8 0 obj\n<< /L 0 >>\nstream\nendstream\nendobj 9 0 obj 5 endobj\n10 0 obj\nstream\nno end\nendobj\n11 0 obj open"
    got = formats._pdf_objects(body)
    assert {n: (o.head, o.data, body[o.at : o.end][-6:]) for n, o in got.items()} == {
        7: (b"\n<< /K (xendobj) >>\n", b"ab\r\n", b"endobj"),
        8: (b"\n<< /L 0 >>\n", b"", b"endobj"),
        9: (b" 5 ", None, b"endobj"),
        10: (b"\nstream\nno end\n", None, b"endobj"),
    }
