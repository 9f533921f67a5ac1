"""The engine's base tables, derived by Spark from the given tables.

customer -> repository, orders -> release, lineitem -> release artifact,
events and documents -> workflow, pages -> security policy, nation and market
segment -> project. Nothing is left out; texts are taken whole.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry import schemas
from attestry.functions.yamljson import spread
from attestry.operators import classify, detect
from attestry.operators import normalise as N
from attestry.plans import project_summary, repo_summary
from attestry.session import configure

# File-name endings of the derived artifacts, by return flag and line number.
SUFFIXES = {
    "A": [".spdx.json", ".cyclonedx.json", "-sbom.json", ".tar.gz.sig", ".tar.gz.ASC",
          "-attestation.jsonl", ".tar.gz"],
    "N": [".cdx.json", ".vex.json", ".intoto.jsonl", "-provenance.json", ".link", ".layout",
          ".zip"],
    "R": [".bundle", ".swidtag", "-cosign.pub", "-LICENSE", ".pem", "-checksums.txt", ".tgz"],
}
PLAIN = ".zip"
# Steps of the derived workflows, by the number in the event's properties; the
# numbers beyond the list run a plain checkout.
STEPS = [
    "anchore/sbom-action@v0\n      - uses: actions/upload-artifact@v4",
    "aquasecurity/trivy-action@0.20.0",
    "make && syft packages dir:. -o spdx-json\n      - uses: softprops/action-gh-release@v2",
    "npx @cyclonedx/cdxgen -o bom.json",
    "opensbom/spdx-sbom-generator@v1",
    "tern report -f spdxjson",
    "sigstore/cosign-installer@v3",
    "sigstore/gh-action-sigstore-python@v2",
    "slsa-framework/slsa-github-generator/.github/workflows/go.yml@v2",
    "notaryproject/notation-action/setup@v1",
    "goreleaser/goreleaser-action@v6",
    "snyk/actions/node@master",
    "twistlock scan\n      - run: clair-scanner image",
    "aquasecurity/aqua-scan@v1",
    "dependabot/fetch-metadata@v2",
    "renovatebot/github-action@v40",
    "whitesource/renovate-check@v1",
    "fossas/fossa-action@main",
    "github/codeql-action/analyze@v3",
    "semgrep ci --config auto",
    "bandit -r src",
    "npm run eslint-security",
    "docker scout cves local://app",
    "anchore/scan-action@v3 # grype",
    "grype dir:. && gh release upload v1 report.txt",
    "microsoft/sbom-tool generate\n      - uses: actions/create-release@v1",
    "kubernetes-sigs/bom generate",
    "oss-review-toolkit/ort-ci-github-action@v1",
    "kyverno apply policy.rego",
    "trivy fs . && syft . && grype .",
]
CHECKOUT = "actions/checkout@v4"
FLOW_HEAD = "\non: push\njobs:\n  main:\n    steps:\n      - uses: "
# Maturity level by region number; other regions have none.
LEVELS = {0: "graduated", 1: "incubating", 2: "sandbox", 3: "archived"}




def _array_sql(items: list[str]) -> str:
    return "array(" + ", ".join(f"'{i}'" for i in items) + ")"


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


class Given:
    """Lazy access to the given tables of one folder and what derives from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table, of one file or many."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Base tables --------------------------------------------------------------

    @cached_property
    def owners(self) -> DataFrame:
        """customer with its nation and region. Nation and region are read as
        they are; the optimiser broadcasts them while their size allows it."""
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    @cached_property
    def repositories(self) -> DataFrame:
        name = _text(F.col("n_name"), "/", F.col("c_name"))
        return self.owners.select(
            _text("R", F.col("c_custkey").cast("string")).alias("id"),
            F.lit("Repository").alias("__typename"),
            F.col("c_name").alias("name"),
            name.alias("nameWithOwner"),
            _text("https://github.com/", name).alias("url"),
            _text(F.col("c_mktsegment"), " software of ", F.col("r_name")).alias("description"),
            (F.col("c_acctbal") > 0).alias("hasVulnerabilityAlertsEnabled"),
            F.lower("c_mktsegment").alias("license_key"),
            F.col("c_mktsegment").alias("license_name"),
            F.lit(None).cast("string").alias("license_spdxId"),
            F.lit("main").alias("defaultBranch_name"),
        )

    @cached_property
    def releases(self) -> DataFrame:
        key = F.col("o_orderkey").cast("string")
        return self.table("orders").select(
            _text("L", key).alias("id"),
            F.lit("Release").alias("__typename"),
            _text("R", F.col("o_custkey").cast("string")).alias("repository_id"),
            F.col("o_orderpriority").alias("name"),
            _text("v", F.col("o_orderdate").cast("date").cast("string")).alias("tagName"),
            _text("https://github.com/releases/", key).alias("url"),
            F.col("o_orderdate").alias("createdAt"),
        )

    @cached_property
    def assets(self) -> DataFrame:
        """Artifacts; those of lines with little discount are plain archives."""
        whens = " ".join(
            f"WHEN '{flag}' THEN try_element_at({_array_sql(ends)}, l_linenumber)"
            for flag, ends in SUFFIXES.items()
        )
        suffix = F.expr(f"IF(l_discount > 0.085D, CASE l_returnflag {whens} END, '{PLAIN}')")
        name = _text("pkg-", F.col("l_partkey").cast("string"), suffix)
        order = F.col("l_orderkey").cast("string")
        return self.table("lineitem").select(
            F.concat_ws(
                "-", F.lit("A"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
            ).alias("id"),
            F.lit("ReleaseAsset").alias("__typename"),
            _text("L", order).alias("release_id"),
            name.alias("name"),
            _text("https://downloads.example.org/", order, "/", name).alias("downloadUrl"),
        )

    @cached_property
    def event_workflows(self) -> DataFrame:
        number = "int(get_json_object(props, '$.k')) + 1"
        step = F.expr(f"coalesce(try_element_at({_array_sql(STEPS)}, {number}), '{CHECKOUT}')")
        return self.table("events").select(
            _text("W", F.col("event_id").cast("string")).alias("id"),
            F.lit("WorkflowFile").alias("__typename"),
            _text("R", F.col("user_id").cast("string")).alias("repository_id"),
            _text(F.col("event_type"), ".yml").alias("filename"),
            _text("name: ", F.col("event_type"), FLOW_HEAD, step).alias("content"),
        )

    @cached_property
    def workflows(self) -> DataFrame:
        key = F.col("doc_id").cast("string")
        texts = self.table("documents").select(
            _text("D", key).alias("id"),
            F.lit("WorkflowFile").alias("__typename"),
            _text("R", key).alias("repository_id"),
            _text(F.col("source"), ".yml").alias("filename"),
            F.col("text").alias("content"),
        )
        return self.event_workflows.unionByName(texts)

    @cached_property
    def security_md(self) -> DataFrame:
        key = F.col("page_id").cast("string")
        return self.table("pages").select(
            _text("P", key).alias("id"),
            F.lit("SecurityMarkdown").alias("__typename"),
            _text("R", key).alias("repository_id"),
            F.lit("SECURITY.md").alias("path"),
            F.col("html").alias("content"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        """Insight documents as JSON text, one per order, in several shapes: lists,
        an object where a list belongs, absent parts, a date that is none."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        key = F.col("o_orderkey").cast("string")
        day = F.col("o_orderdate").cast("date").cast("string")
        updated = F.when(status == "P", F.lit("soon")).otherwise(day)
        version = (
            F.when(status == "F", '"schema-version":"1.0.0",')
            .when(status == "O", '"schema-version":"2.1.0",')
            .otherwise("")
        )
        one = _text('{"name":"rel-', key, '","location":"https://a.example/', key,
                    '","predicate-uri":"https://slsa.dev/', status, '"}')
        two = _text('{"name":"', priority, '","comment":"second"}')
        released = (
            F.when(status == "O", _text('"release":{"attestations":[', one, ",", two, "]},"))
            .when(status == "F", _text('"release":{"attestations":', one, "},"))
            .otherwise("")
        )
        tools = _text('"security":{"tools":[{"results":{"adhoc":', two,
                      '}},{"results":{"ci":', one, ',"release":', two, "}}]}")
        top = F.when(priority < "3", _text('"attestations":[', two, "],")).otherwise("")
        boms = F.when(
            status != "O",
            _text(',"dependencies":{"sbom":[{"sbom-format":"SPDX","sbom-url":"https://s.example/',
                  key, '","comment":"', priority, '"},{"sbom-file":"bom-', key, '.json"}]}'),
        ).otherwise("")
        document = _text(
            '{"header":{', version, '"last-updated":"', updated, '"},"project":{"name":"proj-',
            F.col("o_custkey").cast("string"), '"},"repository":{', released,
            '"url":"https://github.com/o/', key, '",', tools, "},", top,
            '"security-artifacts":{"attestations":[', one, "]}", boms, "}",
        )
        return self.table("orders").select(
            _text("R", F.col("o_custkey").cast("string")).alias("repo_id"),
            _text("https://github.com/own", F.col("o_custkey").cast("string"), "/repo", key,
                  "/blob/HEAD/security-insights.yml").alias("source_url"),
            F.coalesce(F.get_json_object(document, "$.header.schema-version"), F.lit("unknown"))
            .alias("schema_version"),
            document.alias("document"),
            F.col("o_orderdate").alias("fetched_at"),
        )

    @cached_property
    def project_name(self):
        return _text(F.col("n_name"), "-", F.col("c_mktsegment"))

    @cached_property
    def projects(self) -> DataFrame:
        segment, region = F.col("c_mktsegment"), F.col("n_regionkey")
        level = F.coalesce(*[F.when(region == k, v) for k, v in LEVELS.items()])
        per_project = self.owners.groupBy(
            "n_name", "n_regionkey", "r_name", "c_mktsegment"
        ).agg(
            F.count(F.when(F.col("c_acctbal") < -900, 1)).cast("int").alias("audits"),
            F.min("c_custkey").cast("string").alias("first_key"),
        )
        known = {
            "project_name": self.project_name,
            "display_name": _text("Project ", self.project_name),
            "description": _text(segment, " of ", F.col("r_name")),
            "maturity": level,
            "category": segment,
            "subcategory": F.col("r_name"),
            "date_accepted": F.lit("2020-01-01"),
            "homepage_url": _text("https://", F.lower("n_name"), ".example.org/"),
            "repo_url": _text("https://github.com/", F.col("n_name"), "/", F.col("first_key")),
            "package_manager_url": F.when(segment == "BUILDING", "https://packages.example.org/"),
            "docker_url": F.when(segment == "MACHINERY", "https://images.example.org/"),
            "url_for_bestpractices": F.when(region < 2, "https://badge.example.org/"),
            "has_security_audits": F.col("audits") > 0,
            "security_audit_count": F.col("audits"),
            "latest_audit_date": F.when(F.col("audits") > 0, "2024-02-02"),
            "latest_audit_vendor": F.when(F.col("audits") > 0, F.col("r_name")),
        }
        return per_project.select(
            *[
                known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.TABLES["base_cncf_projects"].fields
            ]
        )

    @cached_property
    def project_repos(self) -> DataFrame:
        """Repositories of each project; one segment spells its owners differently
        from the repositories, so those are listed but never found."""
        owner = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lower("n_name")).otherwise(
            F.col("n_name")
        )
        return self.owners.select(
            self.project_name.alias("project_name"),
            owner.alias("owner"),
            F.col("c_name").alias("name"),
            (F.col("c_acctbal") > 5000).alias("primary"),
            F.lit("main").alias("branch"),
        )

    # Model outputs --------------------------------------------------------------

    @cached_property
    def patterns(self) -> DataFrame:
        return classify.artifact_patterns(self.assets, self.releases, self.repositories)

    @cached_property
    def tools(self) -> DataFrame:
        return detect.workflow_tools(self.workflows, self.repositories)

    @cached_property
    def summary(self) -> DataFrame:
        """The repository summary without the identity joins of its inputs."""
        hits = detect.detect_tools(
            self.workflows.select(F.col("id").alias("workflow_id"), "repository_id", "content"),
            "content",
        )
        return repo_summary.with_maturity_score(
            repo_summary.repo_summary(
                self.repositories,
                self.releases,
                classify.classify_assets(self.assets),
                self.workflows,
                hits,
            )
        )

    @cached_property
    def project_summary(self) -> DataFrame:
        return project_summary.project_summary(self.projects, self.project_repos, self.summary)

    # Nested inputs --------------------------------------------------------------

    def _answers(self, rows: DataFrame, parts: dict[str, Column]) -> DataFrame:
        """Log records of rows that carry a customer's columns. A repository has the identity
        and `parts`; a customer deep in debt did not answer."""
        segment = F.col("c_mktsegment")
        name = _text(F.col("n_name"), "/", F.col("c_name"))
        parts = parts | {
            "__typename": F.lit("Repository"),
            "id": _text("R", F.col("c_custkey").cast("string")),
            "name": F.col("c_name"),
            "nameWithOwner": name,
            "url": _text("https://github.com/", name),
        }
        answer = schemas.RESPONSE_LOG["response"].dataType
        repo = F.struct(
            *[
                parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in answer["repository"].dataType.fields
            ]
        )
        metadata = F.struct(
            F.when(segment == "AUTOMOBILE", N.LEGACY).otherwise(N.EXTENDED).alias("queryType"),
            F.lit("2024-05-01T00:00:00Z").alias("timestamp"),
            F.col("n_name").alias("owner"),
            F.col("c_name").alias("repo"),
            F.struct(F.col("n_name").alias("owner"), F.col("c_name").alias("name")).alias("inputs"),
        )
        response = F.struct(F.when(F.col("c_acctbal") >= -900, repo).alias("repository")).cast(answer)
        # A generated column: it is built once a row, not once for each of its fields that is read.
        return rows.select(
            metadata.cast(schemas.RESPONSE_LOG["metadata"].dataType).alias("metadata"),
            F.explode(F.array(response)).alias("response"),
        )

    def _of_owner(self, rows: DataFrame) -> DataFrame:
        """Rows with a repository_id and the columns of its customer."""
        return rows.join(
            self.owners, F.col("repository_id") == _text("R", F.col("c_custkey").cast("string"))
        )

    @cached_property
    def log(self) -> DataFrame:
        """A response log of one record per customer: its identity, rules and known files."""
        node = schemas.RESPONSE_LOG["response"].dataType["repository"].dataType
        no_rule = F.lit(None).cast(node["branchProtectionRules"].dataType["nodes"].dataType.elementType)

        def rule(pattern: str, reviews):
            flags = [F.lit(False).alias(name) for name in N.RULE_COLUMNS[:7]]
            return F.struct(
                F.lit("BranchProtectionRule").alias("__typename"), *flags,
                reviews.cast("int").alias("requiredApprovingReviewCount"),
                F.lit(pattern).alias("pattern"),
            )

        def text_blob(text):
            return F.struct(
                F.lit("Blob").alias("__typename"), F.lit("B").alias("id"), text.alias("text")
            )

        segment = F.col("c_mktsegment")
        insight = _text("header:\n  schema-version: 2.0.0\nproject:\n  name: ", F.col("c_name"), "\n")
        rules = F.array(no_rule, rule("release/*", F.lit(1)), no_rule, rule("v*", F.lit(2)))
        return self._answers(
            spread(self.owners),
            {
                "description": segment,
                "hasVulnerabilityAlertsEnabled": F.col("c_acctbal") > 0,
                "licenseInfo": F.struct(
                    F.lower(segment).alias("key"), segment.alias("name"), F.lit("").alias("spdxId")
                ),
                "defaultBranchRef": F.struct(
                    F.lit("main").alias("name"),
                    F.when(F.col("c_acctbal") > 0, rule("main", F.col("c_nationkey"))).alias(
                        "branchProtectionRule"
                    ),
                ),
                "branchProtectionRules": F.struct(
                    F.when(segment != "HOUSEHOLD", rules).alias("nodes")
                ),
                "securityPolicy": F.when(
                    segment == "BUILDING", text_blob(_text("# Policy of ", F.col("c_name")))
                ),
                "dependabot": F.when(segment == "MACHINERY", text_blob(F.lit("version: 2\n"))),
                "insightsFileRootUpper": F.when(segment == "MACHINERY", text_blob(insight)),
                "insightsFileRootLower": F.when(
                    segment.isin("FURNITURE", "MACHINERY"), text_blob(insight)
                ),
                "insightsFileGithubLower": F.when(
                    segment == "BUILDING", text_blob(F.lit("a: [1, 2\nb: }"))
                ),
            },
        )

    @cached_property
    def release_log(self) -> DataFrame:
        """A response log of one record per release, which holds its artifacts: the lines of one
        order, few by nature."""
        assets = self.assets.groupBy("release_id").agg(
            F.sort_array(
                F.collect_list(F.struct("id", "__typename", "name", "downloadUrl"))
            ).alias("nodes")
        )
        asset = F.transform(
            "nodes", lambda a: F.struct(a["__typename"], a["id"], a["name"], a["downloadUrl"])
        )
        files = F.when(F.col("nodes").isNotNull(), F.array_append(asset, F.lit(None)))
        release = F.struct(
            F.lit("Release").alias("__typename"),
            F.col("id"),
            F.col("name"),
            F.col("tagName"),
            F.col("url"),
            F.date_format("createdAt", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
            F.struct(files.alias("nodes")).alias("releaseAssets"),
        )
        rows = self.releases.join(assets, F.col("id") == F.col("release_id"), "left").select(
            "repository_id", F.array_append(F.array(release), F.lit(None)).alias("rels")
        )
        return self._answers(
            self._of_owner(rows), {"releases": F.struct(F.col("rels").alias("nodes"))}
        )

    @cached_property
    def workflow_log(self) -> DataFrame:
        """A response log of one record per workflow file, next to a folder, which is none."""
        entry = F.struct(
            F.concat_ws("-", "id", "filename").alias("name"),
            F.struct(
                F.lit("Blob").alias("__typename"), F.col("id"), F.col("content").alias("text")
            ).alias("object"),
        )
        folder = F.struct(
            F.lit("scripts").alias("name"),
            F.struct(
                F.lit("Tree").alias("__typename"), F.lit("T").alias("id"),
                F.lit(None).cast("string").alias("text"),
            ).alias("object"),
        )
        rows = self.event_workflows.select("repository_id", F.array(entry, folder).alias("entries"))
        tree = F.struct(F.lit("Tree").alias("__typename"), F.col("entries"))
        return self._answers(self._of_owner(rows), {"workflows": tree})

    @cached_property
    def event_log(self) -> DataFrame:
        """A response log with many records per key: one per event."""
        return self.table("events").select(
            F.struct(
                F.col("event_type").alias("queryType"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                F.lit("org").alias("owner"),
                F.col("user_id").cast("string").alias("repo"),
            ).alias("metadata"),
            F.struct(
                F.struct(F.col("event_id").cast("string").alias("id")).alias("repository")
            ).alias("response"),
        )

    @cached_property
    def project_list(self) -> DataFrame:
        """Input entries in both shapes: projects, one entry for each repository of theirs, and
        plain targets."""
        ref = F.struct("owner", "name", "primary", "branch")
        repos = self.project_repos.select("project_name", F.array(ref).alias("repos"))
        rich = self.projects.join(repos, "project_name").select(
            F.lit(None).cast("string").alias("owner"),
            F.lit(None).cast("string").alias("name"),
            *schemas.PROJECT_COLUMNS,
            "repos",
        )
        plain = self.table("supplier").select(
            F.lit("suppliers").alias("owner"), F.col("s_name").alias("name")
        )
        return rich.unionByName(plain, allowMissingColumns=True)

    @cached_property
    def landscape(self) -> DataFrame:
        """A landscape document per supplier, under one of the two root keys."""
        item = F.struct(
            F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") > 0, F.lit("Incubating")).alias("project"),
            F.when(
                F.col("s_acctbal") < 5000,
                _text("https://github.com/org", F.col("s_nationkey").cast("string"), "/",
                      F.col("s_suppkey").cast("string")),
            )
            .otherwise(_text("https://git.example.org/", F.col("s_name"), "/"))
            .alias("repo_url"),
            F.lit("main").alias("branch"),
            F.array(
                F.struct(
                    _text("https://github.com/extra/", F.col("s_suppkey").cast("string")).alias(
                        "repo_url"
                    ),
                    F.lit("dev").alias("branch"),
                ),
                F.struct(
                    F.lit("https://github.com/extra/deep/path/").alias("repo_url"),
                    F.lit("dev").alias("branch"),
                ),
            ).alias("additional_repos"),
            F.struct(
                F.lit("2021-01-01").alias("accepted"),
                F.array(
                    F.struct(F.lit("2022-01-01").alias("date"), F.lit("first").alias("vendor")),
                    F.struct(F.lit("2023-01-01").alias("date"), F.col("s_name").alias("vendor")),
                ).alias("audits"),
                F.array(F.lit("tag1"), F.lit("tag2")).alias("tag"),
            ).alias("extra"),
        )
        category = F.struct(
            _text("cat-", F.col("s_nationkey").cast("string")).alias("name"),
            F.array(
                F.struct(F.lit("sub").alias("name"), F.array(item).alias("items"))
            ).alias("subcategories"),
        )
        document = F.to_json(
            F.struct(
                F.when(F.col("s_acctbal") >= 2000, F.array(category)).alias("landscape"),
                F.when(F.col("s_acctbal") < 2000, F.array(category)).alias("categories"),
            )
        )
        return self.table("supplier").select(
            F.from_json(document, schemas.LANDSCAPE).alias("doc")
        )

    def base_tables(self) -> dict[str, DataFrame]:
        return {
            "base_repositories": self.repositories,
            "base_releases": self.releases,
            "base_release_assets": self.assets,
            "base_workflows": self.workflows,
            "base_security_md": self.security_md,
            "base_si_documents": self.documents,
            "base_cncf_projects": self.projects,
            "base_cncf_project_repos": self.project_repos,
        }
