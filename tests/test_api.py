import os

import pytest
from pyspark.sql import functions as F

from warraq.__main__ import main
from warraq.plans.api import Corpus, CorpusMissing, InputError

DATA = os.environ.get("WARRAQ_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def corpus(spark):
    return Corpus(spark, DATA)


def test_verse_and_absence(corpus):
    seg = corpus.segments.where("label rlike '^[0-9]+$' and from_page <= to_page").first()
    rows = corpus.verse(f"{seg.surah}:{seg.label}").collect()
    assert any(r.seg_id == seg.seg_id and r.status == "found" for r in rows)
    sources = {r.source for r in corpus.sources.collect()}
    assert {r.source for r in rows} <= sources and any(r.status == "absent" for r in rows)
    small = corpus.verse(f"{seg.surah}:{seg.label}", budget=1).where("status = 'found'")
    assert small.groupBy("seg_id").count().where("count > 1").count() == 0
    assert {r.source for r in corpus.verse("1:1", sources=seg.source).collect()} == {seg.source}
    assert corpus.intro(seg.surah).count() > 0
    for bad in ("0", "115:1", "x", "2:1:1"):
        with pytest.raises(InputError):
            corpus.verse(bad)
    with pytest.raises(InputError):
        corpus.verse("1", sources="no such book")


def test_text_and_toc(corpus):
    seg = corpus.event_segments_table.where("from_page < to_page").orderBy("seg_id").first()
    full = corpus.text(seg.seg_id, events=True).collect()
    assert [r.rel_idx for r in full] == list(range(len(full)))
    part = corpus.text(seg.seg_id, events=True, paras="1-2").collect()
    assert [r.text for r in part] == [r.text for r in full][1:3]
    assert all(not r.is_verse for r in corpus.text(seg.seg_id, events=True, skip_verse=True).collect())
    with pytest.raises(InputError):
        corpus.text(seg.seg_id, paras="3-1")
    assert corpus.toc([seg.seg_id], events=True).agg(F.sum("n_chars")).first()[0] == sum(len(r.text) for r in full)


def test_names_years_numbers(corpus):
    event = corpus.event_segments_table.where("from_page <= to_page and event_id is not null").first().event_id
    assert {r.status for r in corpus.event(event).collect()} <= {"found", "absent"}
    assert {r.status for r in corpus.event("لا يوجد هذا").collect()} == {"absent"}
    year = corpus.registry.where("year_h is not null").first().year_h
    assert corpus.year(year).where("status = 'found'").count() > 0
    assert [r.status for r in corpus.year(9999).collect()] == ["absent"]
    assert corpus.person("1").count() > 0 and [r.status for r in corpus.person("غغغغغ").collect()] == ["absent"]
    got = corpus.entries_by_number("kamus_asl:1-3,999999").collect()
    assert [r.status for r in got if r.num == 999999] == ["missing"] and any(r.status == "found" for r in got)
    with pytest.raises(InputError):
        corpus.entries_by_number("kamus_asl:5-1")


def test_search(corpus):
    rows = corpus.full_text("قال", limit=5).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and all("قال" in r.snippet.replace("َ", "") for r in rows)
    with pytest.raises(InputError):
        corpus.full_text("  ")
    assert corpus.search("بيعة").count() > 0 and corpus.headings("باب").count() >= 0
    assert corpus.coverage().count() == corpus.info().count() == corpus.sources.count()
    assert corpus.verse_coverage().where("percent > 100 or (percent = 100) <> (missing is null)").count() == 0 and corpus.events().count() > 0


def test_command_line(spark, capsys, tmp_path):
    assert main([DATA, "year", "x"]) == 2
    for wrong in (["verse", "1:1", "--paras", "1-2"], ["text", "1", "--limit", "3"], ["info", "x"], ["year"], ["find", "x", "--skip-verse"], ["verse", "1:8"], ["verse", "115"], ["entries", "x"], ["event", "x", "--sources", "nowhere"]):
        assert main([DATA, *wrong]) == 2, wrong
    assert main([str(tmp_path), "events"]) == 3
    assert main([DATA, "info"]) == 0
    assert capsys.readouterr().out.count('"source"') > 0
    with pytest.raises(CorpusMissing):
        Corpus(spark, str(tmp_path)).events()


def test_reasons_ranges_and_offsets(corpus):
    rows = corpus.verse("78").collect()
    assert {r.source for r in rows} == {r.source for r in corpus.sources.collect()}
    assert all((r.status == "absent") == (r.reason is not None) for r in rows) and len({r.source for r in rows}) == len({(r.source, r.ord) for r in rows})
    seg = corpus.event_segments_table.where("from_page < to_page").first()
    n = corpus.text(seg.seg_id, events=True).count()
    assert corpus.text(seg.seg_id, events=True, paras=f"0-{n + 50}").count() == n
    with pytest.raises(InputError):
        corpus.text(seg.seg_id, events=True, paras=f"{n}-{n + 1}")
    first = corpus.entries_by_number("kamus_asl:1-10", budget=60).collect()
    assert first[-1].next_offset == len(first)
    rest = corpus.entries_by_number("kamus_asl:1-10", offset=len(first)).collect()
    assert [r["item"] for r in first + rest] == list(range(len(first) + len(rest))) and rest[-1].next_offset is None
    assert {r.status for r in corpus.entries_by_number("nowhere:1").collect()} == {"missing"}
