"""Detection rules on file names and workflow texts, and keyword semantics."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attestry.functions import rules as R
from attestry.functions import text as X
from attestry.operators.classify import classify_assets
from attestry.operators.detect import detect_tools, pattern_counts

NAMES = [
    ("project-v1.0.0.spdx.json", {"is_sbom"}, "spdx"),
    ("sbom.spdx", {"is_sbom"}, "spdx"),
    ("dependencies.spdx.rdf", {"is_sbom"}, "spdx"),
    ("bom.cyclonedx.json", {"is_sbom"}, "cyclonedx"),
    ("sbom.cdx.xml", {"is_sbom"}, "cyclonedx"),
    ("vulnerability-disclosure.cdx.json", set(), "cyclonedx"),
    ("my-sbom.json", {"is_sbom"}, "unknown"),
    ("SBOM_amd64.JSON", {"is_sbom"}, "unknown"),
    ("software.swidtag", {"is_swid_tag"}, None),
    ("component.swid.json", {"is_swid_tag"}, None),
    ("binary-v1.0.0.tar.gz.sig", {"is_signature"}, None),
    ("checksums.txt.ASC", {"is_signature"}, None),
    ("signing-key.pub", {"is_signature"}, None),
    ("sig", set(), None),
    ("build-attestation.json", {"is_attestation"}, None),
    ("security-advisory.vex", {"is_vex"}, None),
    ("build-provenance.slsa.json", {"is_slsa_provenance"}, None),
    ("artifact.intoto.jsonl", {"is_slsa_provenance"}, None),
    ("test-step.link.json", {"is_in_toto_link"}, None),
    ("supply-chain.layout", {"is_in_toto_layout"}, None),
    ("artifact.bundle", {"is_sigstore_bundle"}, None),
    ("image.cosign.json", {"is_container_attestation"}, None),
    ("fulcio-certificate.pem", {"is_container_attestation", "is_signature"}, None),
    ("LICENSE", {"is_license_file"}, None),
    ("NOTICE.txt", {"is_license_file"}, None),
    ("COPYRIGHT", set(), None),
    ("blinked.zip", set(), None),
    ("tool_linux_amd64.tar.gz", set(), None),
]


def test_artifact_names(spark):
    frame = spark.createDataFrame([(n,) for n, _, _ in NAMES], "name string")
    got = {r["name"]: r for r in classify_assets(frame).collect()}
    for name, flags, sbom_format in NAMES:
        raised = {f for f in R.ARTIFACT_FLAGS if got[name][f]}
        assert (raised, got[name]["sbom_format"]) == (flags, sbom_format), name


FLOWS = [
    ("uses: anchore/sbom-action@v0", {("vulnerability-scanner", "anchore")}),
    ("uses: aquasecurity/trivy-action@master",
     {("sbom-generator", "trivy"), ("container-scanner", "trivy")}),
    ("run: npx cdxgen -o bom.json", {("sbom-generator", "cdxgen")}),
    ("uses: opensbom/spdx-sbom-generator@v1", {("sbom-generator", "spdx-sbom-generator")}),
    ("run: spdx sbom\n  generator", {("sbom-generator", "spdx-sbom-generator")}),
    ("run: tern report", {("sbom-generator", "tern")}),
    ("run: external pattern", set()),
    ("uses: sigstore/cosign-installer@v3", {("signer", "cosign")}),
    ("uses: slsa-framework/slsa-github-generator/x@v1", {("signer", "slsa-github-generator")}),
    ("run: notaryproject verify", {("signer", "notation")}),
    ("uses: goreleaser/goreleaser-action@v5", {("goreleaser", "goreleaser")}),
    ("run: goreleaser release", set()),
    ("uses: docker/scout-action@v1", {("container-scanner", "docker-scout")}),
    ("run: docker scout cves", {("container-scanner", "docker-scout")}),
    ("uses: github/codeql-action/init@v2", {("code-scanner", "codeql")}),
    ("run: syft . && trivy fs .", {("sbom-generator", "syft"), ("container-scanner", "trivy")}),
    ("uses: actions/checkout@v4", set()),
    ("uses: github/super-linter@v5", set()),
    ("", set()),
    (None, set()),
]


def test_first_match_per_category(spark):
    frame = spark.createDataFrame(list(enumerate(t for t, _ in FLOWS)), "id int, content string")
    got = {i: set() for i in range(len(FLOWS))}
    for r in detect_tools(frame, "content").collect():
        got[r["id"]].add((r["tool_category"], r["tool_name"]))
    assert got == {i: want for i, (_, want) in enumerate(FLOWS)}


def test_all_matches_and_any_token(spark, rows):
    frame = spark.createDataFrame([(1, "syft and trivy"), (2, "a github action")], "id int, content string")
    every = rows(detect_tools(frame, "content", all_matches=True), "id", "tool_category", "tool_name")
    assert every == [
        (1, "container-scanner", "trivy"), (1, "sbom-generator", "syft"), (1, "sbom-generator", "trivy"),
    ]
    loose = rows(detect_tools(frame, "content", mode="any_token"), "id", "tool_name")
    assert (2, "slsa-github-generator") in loose and (2, "goreleaser") in loose


def test_optional_rules_are_off(spark, rows):
    frame = spark.createDataFrame([(1, "kyverno apply policy.rego")], "id int, content string")
    assert rows(detect_tools(frame, "content")) == []
    assert rows(detect_tools(frame, "content", R.OPTIONAL_TOOL_RULES), "tool_name") == [("kyverno",), ("opa",)]


def test_pattern_counts_keeps_empty_patterns(spark, rows):
    frame = spark.createDataFrame(
        [("w1", "r1", "syft"), ("w2", "r1", "anchore/sbom-action"), ("w3", "r2", "syft")],
        "id string, repo string, content string",
    )
    counts = pattern_counts(frame, "id", "repo", "content", R.GENERATOR_PATTERNS)
    got = {r["tool"]: (r["repos"], r["workflows"]) for r in counts.collect()}
    assert got["syft"] == (2, 3) and got["bom"] == (0, 0) and len(got) == 7


def test_rule_table_lists_every_rule(spark):
    table = R.rule_table(spark)
    assert table.filter("NOT enabled").count() == len(R.OPTIONAL_TOOL_RULES)
    assert table.filter("subject = 'artifact'").count() == len(R.ARTIFACT_FLAGS)


TERMS = ["syft", "spdx-sbom-generator", "docker scout OR grype", "a", "mit license"]
LETTERS = st.sampled_from(list("asyftspdxmitlicensedockergrype-_ .\n019ÉKſé") + [
    "syft", "spdx", "sbom", "generator", "docker", "scout", "mit", "license", " ", "-",
])


def reference_match(text, query):
    return any(
        re.search(
            "(^|[^a-zA-Z])" + "[^a-zA-Z]+".join(re.findall("[a-z]+", term)) + "($|[^a-zA-Z])",
            text,
            re.I | re.A,
        )
        for term in query.split(" OR ")
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(LETTERS, max_size=12).map("".join), min_size=30, max_size=60))
def test_matching_equals_regular_expression(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    known = X.known_words_sql("w", TERMS)
    prepared = X.with_words(frame, "t", "w").selectExpr("*", f"explode(array({known})) AS k")
    got = prepared.selectExpr(
        "id",
        *[f"{X.match_sql('w', q)} AS direct{i}" for i, q in enumerate(TERMS)],
        *[f"{X.listed_match_sql('k', 'w', q)} AS listed{i}" for i, q in enumerate(TERMS)],
    ).collect()
    for row in got:
        for i, query in enumerate(TERMS):
            want = reference_match(texts[row["id"]], query)
            assert row[f"direct{i}"] == want == row[f"listed{i}"], (texts[row["id"]], query)


@pytest.mark.parametrize("text,count", [("a b a", 3), ("", 0), ("12 --", 0), ("Éa x9y", 3), (None, None)])
def test_word_count(spark, text, count):
    frame = spark.createDataFrame([(text,)], "t string")
    row = frame.select(X.word_count(X.words(F.col("t"))), F.size(X.tokens(F.col("t")))).first()
    assert row[0] == count
    if count is not None:
        assert row[1] == count


def test_term_frequency_counts_neighbours(spark):
    frame = spark.createDataFrame([("mit mit-mit permit MIT",)], "t string")
    assert frame.select(X.term_frequency(X.words(F.col("t")), "mit")).first()[0] == 4


def test_unknown_mode():
    with pytest.raises(ValueError):
        X.needles("a", "fuzzy")
