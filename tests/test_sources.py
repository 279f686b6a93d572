"""VCF and TSV scans on hand-made text."""

from __future__ import annotations

import gzip
import os
import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from alleleframe.operators.reshape import explode_alternates, flatten_structs
from alleleframe.plans.ingest import annotations_from_tsv, genes_from_tsv, variants_from_vcf
from alleleframe.sources import block_gzip, tables, vcf
from checks import derived

HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency, with ID=x, Type=y">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Number">',
    '##INFO=<ID=lcr,Number=0,Type=Flag,Description="Flag">',
    '##INFO=<ID=note,Number=.,Type=String,Description="Text">',
    '##FILTER=<ID=AC0,Description="Zero count">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
]
RECORDS = [
    "chr1\t10\trs1\tA\tT,G\t.\tPASS\tAF=0.1,0.2;AN=5;lcr",
    "chr1\t12\t.\tC\tG\t3.5\tAC0;AS_VQSR\tAF=.;AN=7",
    "chr1\t13\t.\tC\t.\t3.5\tPASS\tAN=7",
]


def write_vcf(path, records, header=HEADER, compress=False):
    text = "\n".join([*header, *records]) + "\n"
    path.write_bytes(gzip.compress(text.encode()) if compress else text.encode())
    return str(path)


def test_sample_zero_based(spark, tmp_path):
    path = write_vcf(tmp_path / "a.vcf", RECORDS)
    flat = variants_from_vcf(spark, path, one_based=False)
    keys = ["contigName", "start", "referenceAllele", "alternateAllele", "filters", "INFO_AF"]
    assert rows(flat, *keys) == [
        ("chr1", 11, "C", "G", "AC0", None),
        ("chr1", 9, "A", "G", None, 0.2),
        ("chr1", 9, "A", "T", "PASS", 0.1),
    ]


def test_positions_are_one_based_by_default(spark, tmp_path):
    path = write_vcf(tmp_path / "a.vcf", RECORDS)
    nested = vcf.read_vcf(spark, path)
    assert rows(nested, "start", "end") == [(10, 10), (12, 12), (13, 13)]


def test_typed_info(spark, tmp_path):
    path = write_vcf(tmp_path / "a.vcf", RECORDS)
    nested = vcf.read_vcf(spark, path)
    types = dict(nested.select("INFO.*").dtypes)
    assert types == {"AF": "array<double>", "AN": "bigint", "lcr": "boolean", "note": "array<string>"}
    assert rows(nested, "start", "INFO.AN", "INFO.lcr", "names", "qual") == [
        (10, 5, True, ["rs1"], None),
        (12, 7, False, None, 3.5),
        (13, 7, False, None, 3.5),
    ]


def test_odd_info_text(spark, tmp_path):
    """Repeated keys, empty entries, quotes, backslashes and ``=`` inside values."""
    records = [
        "chr1\t1\t.\tA\tT\t.\tPASS\tAF=0.1;AF=0.5;;AN=3;",
        'chr1\t2\t.\tA\tT\t.\tPASS\tnote=a"b\\c,p=q,.;AN=x',
        "chr1\t3\t.\tA\tT\t.\tPASS\t.",
        "chr1\t4\t.\tA\tT",
    ]
    nested = vcf.read_vcf(spark, write_vcf(tmp_path / "a.vcf", records))
    assert rows(nested, "start", "INFO.AF", "INFO.AN", "INFO.note") == [
        (1, [0.5], 3, None),
        (2, None, None, ['a"b\\c', "p=q", None]),
        (3, None, None, None),
        (4, None, None, None),
    ]


def test_gzip_shards_share_one_header(spark, tmp_path):
    """Multi-member gzip, as block-gzip tools write it, reads completely."""
    first = tmp_path / "chr1.vcf.gz"
    write_vcf(first, RECORDS, compress=True)
    first.write_bytes(first.read_bytes() + gzip.compress((RECORDS[1] + "\n").encode()))
    second = write_vcf(tmp_path / "chr2.vcf.gz", [r.replace("chr1", "chr2") for r in RECORDS], compress=True)
    nested = vcf.read_vcf(spark, [str(first), second])
    assert rows(nested.groupBy("contigName").count()) == [("chr1", 4), ("chr2", 3)]


def test_fields_of_all_headers_are_read(spark, tmp_path):
    first = write_vcf(tmp_path / "a.vcf", RECORDS)
    more = [*HEADER[:-1], '##INFO=<ID=extra,Number=1,Type=Integer,Description="x">', HEADER[-1]]
    second = write_vcf(tmp_path / "b.vcf", ["chr2\t5\t.\tA\tT\t.\tPASS\tAN=1;extra=9"], header=more)
    nested = vcf.read_vcf(spark, [first, second])
    assert rows(nested, "contigName", "INFO.extra")[-1] == ("chr2", 9)
    other = [line.replace("ID=AN,Number=1,Type=Integer", "ID=AN,Number=1,Type=Float") for line in HEADER]
    third = write_vcf(tmp_path / "c.vcf", RECORDS, header=other)
    with pytest.raises(ValueError, match="AN"):
        vcf.read_vcf(spark, [first, third])
    assert vcf.read_vcf(spark, [first, third], header=HEADER).count() == 6


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    """Plain, gzip and block-gzip files; only different headers come to the driver."""
    for i in range(300):
        path = tmp_path / f"{i:04d}.vcf{['', '.gz', '.bgz'][i % 3]}"
        text = "\n".join([*HEADER, *RECORDS]).encode() + b"\n"
        path.write_bytes([bytes, gzip.compress, derived.block_gzip_bytes][i % 3](text))
    files = [str(p) for p in tmp_path.iterdir()]
    spark.sparkContext.setJobGroup("headers", "headers")
    found = vcf.all_headers(spark, files)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(found.values()) == [HEADER]
    # The last stage of a sorted result may be a job of its own.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 4
    assert vcf.read_vcf(spark, str(tmp_path)).count() == 900


def block_gzip_file(path, lines, size):
    path.write_bytes(derived.block_gzip_bytes("".join(f"{x}\n" for x in lines).encode(), size))
    return str(path)


@pytest.mark.parametrize("size", [7, 100, 0xFF00])
@pytest.mark.parametrize("split", [60, 1000, 1 << 20])
def test_ranges_of_a_block_gzip_file_give_every_line_once(tmp_path, size, split):
    """Lines shorter and longer than members and ranges, empty ones, and line ends at member ends."""
    draw = random.Random(size)
    lines = ["", "x" * 3000, "abcdef", "1234567" * 2, *["y" * draw.randint(0, 90) for _ in range(150)], "", "end"]
    path = block_gzip_file(tmp_path / "a.bgz", lines, size)
    total = os.path.getsize(path)
    found = []
    with open(path, "rb") as file:
        for start in range(0, total, split):
            for some in block_gzip.lines_of_range(file, start, min(start + split, total), total):
                found += [x.decode() for x in some]
    assert found == lines


@pytest.mark.parametrize("size", [7, 1000, 0xFF00])
def test_block_gzip_members_are_written_as_texts_come(size):
    """Not after all texts of a task are held."""
    texts, taken = [b"%d" % i * 60 for i in range(3000)], []
    parts = derived.block_gzip_parts((taken.append(0) or x for x in texts), size)
    first = next(parts)
    assert len(taken) < 600
    whole = first + b"".join(parts)
    assert whole == derived.block_gzip_bytes(b"".join(texts), size)
    assert gzip.decompress(whole) == b"".join(texts)


def test_every_task_names_a_whole_block_gzip_file(spark, tmp_path):
    lines = spark.range(0, 30000, 1, 3).selectExpr("concat('line ', id) AS value")
    paths = [r.path for r in derived.write_block_gzip(lines, str(tmp_path), HEADER, 5000).collect()]
    assert sorted(os.listdir(tmp_path)) == [f"part-{i:05d}.vcf.bgz" for i in range(3)]
    found = [x for p in sorted(paths) for x in gzip.open(p, "rt").read().splitlines() if not x.startswith("#")]
    assert found == [f"line {i}" for i in range(30000)]


def test_a_last_line_without_its_end(tmp_path):
    (tmp_path / "a.bgz").write_bytes(derived.block_gzip_bytes(b"one\ntwo", 3))
    with open(tmp_path / "a.bgz", "rb") as file:
        size = os.path.getsize(tmp_path / "a.bgz")
        found = [x for s in range(0, size, 20) for some in block_gzip.lines_of_range(file, s, s + 20, size) for x in some]
    assert found == [b"one", b"two"]


def test_block_gzip_gives_many_tasks_and_equals_plain_text(spark, tmp_path):
    records = [f"chr1\t{i}\trs{i}\tA\tT,G\t.\tPASS\tAF={i / 9000},0.2;AN={i};note={'n' * (i % 400)}" for i in range(9000)]
    plain = write_vcf(tmp_path / "a.vcf", records)
    (tmp_path / "b.vcf.bgz").write_bytes(derived.block_gzip_bytes((tmp_path / "a.vcf").read_bytes(), 4000))
    size = os.path.getsize(tmp_path / "b.vcf.bgz")
    lines = block_gzip.read_lines(spark, [(str(tmp_path / "b.vcf.bgz"), size)], split_bytes=size // 40)
    assert lines.rdd.getNumPartitions() >= 40
    assert lines.count() == len(records) + len(HEADER)
    fields = vcf.info_fields(HEADER)
    ours = vcf.parse_vcf_lines(lines, fields)
    assert ours.exceptAll(vcf.read_vcf(spark, plain)).isEmpty()
    assert vcf.read_vcf(spark, str(tmp_path / "b.vcf.bgz")).exceptAll(ours).isEmpty()


def test_a_cut_off_block_gzip_file_fails(spark, tmp_path):
    whole = derived.block_gzip_bytes(("\n".join([*HEADER, *RECORDS * 200]) + "\n").encode(), 900)
    (tmp_path / "a.bgz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(PySparkException, match="member"):
        vcf.read_vcf(spark, str(tmp_path / "a.bgz"), header=HEADER).count()


def test_plain_gzip_named_bgz_fails_with_a_reason(spark, tmp_path):
    write_vcf(tmp_path / "a.vcf.bgz", RECORDS, compress=True)
    with pytest.raises(PySparkException, match="block-gzip"):
        vcf.read_vcf(spark, str(tmp_path), header=HEADER).count()


def test_arrays_are_cut_by_their_declared_number(spark, tmp_path):
    header = [
        "##fileformat=VCFv4.2",
        "##INFO=<ID=AF,Number=A,Type=Float>",
        "##INFO=<ID=AD,Number=R,Type=Integer>",
        "##INFO=<ID=GC,Number=G,Type=Integer>",
        "##INFO=<ID=H,Number=.,Type=Integer>",
    ]
    records = [
        "chr1\t1\t.\tA\tT,G\t.\tAC0;X\tAF=0.1,0.2;AD=5,6,7;GC=0,1,2,3,4,5;H=8,9",
        "chr1\t2\t.\tA\tC\t.\tPASS\tAF=0.5;AD=5;GC=1,2,3",
    ]
    flat = variants_from_vcf(spark, write_vcf(tmp_path / "a.vcf", records, header), align="declared")
    assert rows(flat, "alternateAllele", "filters", "INFO_AF", "INFO_AD", "INFO_GC", "INFO_H") == [
        ("C", "PASS", 0.5, [5, None], [1, 2, 3], None),
        ("G", "AC0;X", 0.2, [5, 7], [0, 3, 5], [8, 9]),
        ("T", "AC0;X", 0.1, [5, 6], [0, 1, 2], [8, 9]),
    ]


def test_nameless_info_entries_are_skipped(spark, tmp_path):
    records = [f"chr1\t{i}\t.\tA\tT\t.\tPASS\t{info}" for i, info in enumerate(["AF=0.1;=x", "=x;AF=0.1", "=", "=;=;AF=0.1;"])]
    nested = vcf.read_vcf(spark, write_vcf(tmp_path / "a.vcf", records))
    assert rows(nested, "start", "INFO.AF") == [(0, [0.1]), (1, [0.1]), (2, None), (3, [0.1])]


def test_aligned_arrays_leave_filters_whole(spark, tmp_path):
    path = write_vcf(tmp_path / "a.vcf", RECORDS)
    flat = variants_from_vcf(spark, path, align=["INFO_AF"])
    assert rows(flat, "alternateAllele", "filters", "INFO_AF")[:2] == [
        ("G", "AC0;AS_VQSR", None),
        ("G", "PASS", 0.2),
    ]


def test_shard_folders_must_have_the_same_columns(spark, tmp_path):
    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(one)
    spark.createDataFrame([("b", 2)], "v string, k int").write.parquet(two)
    spark.createDataFrame([(3, "c", 1)], "k int, v string, extra int").write.parquet(three)
    assert rows(tables.read_parquet(spark, [one, two]), "k", "v") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="three"):
        tables.read_parquet(spark, [one, two, three])


def test_long_header_is_read_completely(spark, tmp_path):
    many = [f'##INFO=<ID=F{i},Number=A,Type=Float,Description="x">' for i in range(3000)]
    path = write_vcf(tmp_path / "a.vcf", ["chr1\t1\t.\tA\tT\t.\tPASS\tF2999=0.5"], header=many)
    assert len(vcf.info_fields(vcf.header_lines(spark, path))) == 3000
    assert vcf.read_vcf(spark, path, fields=["F2999"]).first().INFO.F2999 == [0.5]


def test_unknown_field_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="nope"):
        vcf.read_vcf(spark, write_vcf(tmp_path / "a.vcf", RECORDS), fields=["nope"])


def test_round_trip_of_whole_table(spark, sf_dir):
    nested = derived.nested_variants(spark, sf_dir)
    parsed = vcf.parse_vcf_lines(derived.vcf_lines(nested), vcf.info_fields(derived.VCF_HEADER))
    flat = lambda df: explode_alternates(flatten_structs(df.select(*nested.columns)))
    before, after = flat(nested), flat(parsed)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


ANNOTATION_HEADER = "#chr\tpos(1-based)\tref\talt\tgenename\tscore"


def test_annotation_keys(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(f"{ANNOTATION_HEADER}\n1\t9\tA\tT\tG1\t.\n1\t10\tA\tT\t\tx\nX\tbad\tA\tT\tG2\t1\n")
    notes = annotations_from_tsv(spark, str(tmp_path))
    assert dict(notes.dtypes)["start_position"] == "bigint"
    ordered = [tuple(r) for r in notes.orderBy("start_position").collect()]
    assert ordered == [
        ("chrX", None, "A", "T", "G2", "1"),
        ("chr1", 9, "A", "T", "G1", "."),
        ("chr1", 10, "A", "T", None, "x"),
    ]


def test_missing_mark_is_kept_unless_asked(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("a\tb\n.\t1\n")
    assert rows(tables.read_tsv(spark, str(tmp_path))) == [(".", "1")]
    assert rows(tables.read_tsv(spark, str(tmp_path), null_value=".")) == [(None, "1")]


def test_shard_with_other_header_fails(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "b.tsv").write_text("b\ta\n1\t2\n")
    with pytest.raises(Exception, match="header does not conform"):
        tables.read_tsv(spark, str(tmp_path)).collect()
    unchecked = tables.read_tsv(spark, str(tmp_path), check_headers=False)
    assert unchecked.count() == 2


def test_union_goes_by_name(spark):
    first = spark.createDataFrame([(1, 2)], "a int, b int")
    second = spark.createDataFrame([(3, 4)], "b int, a int")
    assert rows(tables.union_shards([first, second])) == [(1, 2), (4, 3)]
    with pytest.raises(PySparkException):
        tables.union_shards([first, spark.createDataFrame([(1,)], "a int")])


def test_genes(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("Gene_name\tGene.full\nG1\tx\nG2\t\nG3\t" + "y" * 65536 + "\n")
    assert rows(genes_from_tsv(spark, str(tmp_path / "g.tsv"))) == [("G1", "x")]
    assert rows(genes_from_tsv(spark, str(tmp_path / "g.tsv"), keep_nulls=True)) == [("G1", "x"), ("G2", None)]
    marked = tmp_path / "marked"
    marked.mkdir()
    (marked / "g.tsv").write_text("Gene_name\tnote\nG1\tx\nG2\t.\nG3\t.\n")
    assert genes_from_tsv(spark, str(marked), null_value=".").count() == 3
    with pytest.raises(ValueError, match="keep_nulls"):
        genes_from_tsv(spark, str(marked), null_value=".", keep_nulls=False)
    assert genes_from_tsv(spark, str(tmp_path / "g.tsv")).columns == ["Gene_name", "Gene_full"]


def test_few_info_fields_read_like_many(spark, tmp_path, monkeypatch):
    """A field looked up by itself has the value the whole INFO text as JSON gives it."""
    header = [
        "##fileformat=VCFv4.2",
        "##INFO=<ID=AF,Number=A,Type=Float>",
        "##INFO=<ID=F,Number=1,Type=Float>",
        "##INFO=<ID=N,Number=.,Type=Integer>",
        "##INFO=<ID=S,Number=1,Type=String>",
        "##INFO=<ID=T.x,Number=.,Type=String>",
        "##INFO=<ID=DB,Number=0,Type=Flag>",
    ]
    entries = ["AF=.", "AF=0.1,.", "AF=1", "AF", "AF=", "=AF=2", "XAF=9", "F=.", "F=x", "F=2", "N=1,x,.", "N=."]
    entries += ["S=a=b", "S", 'S="\\é', "S=.", "T.x=a,.", "Tzx=1", "T.x", "DB", "DB=1", "DBX", "af=3", "", "=", "S=a,"]
    draw = random.Random(5)
    infos = [".", "", *entries, *(";".join(draw.choices(entries, k=draw.randint(1, 6))) for _ in range(400))]
    records = [f"chr1\t{i}\t.\tA\tT\t.\tPASS\t{info}" for i, info in enumerate(infos)] + ["chr1\t9999\t.\tA\tT\t.\tPASS"]
    path = write_vcf(tmp_path / "a.vcf", records, header)
    few = vcf.read_vcf(spark, path)
    assert "from_json" not in few._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(vcf, "_MOST_LOOKUPS", 0)
    many = vcf.read_vcf(spark, path)
    key = lambda df: sorted((r.start, repr(r.INFO and r.INFO.asDict())) for r in df.collect())
    assert few.schema == many.schema
    assert [p for p in zip(key(few), key(many)) if p[0] != p[1]] == []


def test_a_line_is_split_once(spark, tmp_path):
    flat = variants_from_vcf(spark, write_vcf(tmp_path / "a.vcf", RECORDS), header=HEADER)
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1
