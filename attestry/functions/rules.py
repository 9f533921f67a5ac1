"""The detection rule catalogue as data.

Adding a detection means adding a line here (or passing an own list to the
operators). Every rule is a ``'a OR b'`` query, see ``functions.text``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ToolRule:
    """A workflow holding ``query`` uses ``tool`` of ``category``."""

    category: str
    tool: str
    query: str


# Artifact name rules (flag column -> keyword query).
ARTIFACT_KEYWORDS: dict[str, str] = {
    "is_sbom": "sbom OR spdx OR cyclonedx",
    "is_attestation": "attestation",
    "is_vex": "vex",
    "is_slsa_provenance": "provenance OR slsa OR intoto",
    "is_in_toto_link": "link",
    "is_in_toto_layout": "layout",
    "is_swid_tag": "swid OR swidtag",
    "is_container_attestation": "cosign OR rekor OR fulcio",
    "is_license_file": "license OR copying OR notice",
}

# Artifact name rules by file-name ending.
ARTIFACT_EXTENSIONS: dict[str, list[str]] = {
    "is_signature": ["sig", "asc", "pem", "pub"],
    "is_sigstore_bundle": ["bundle"],
}

# Flag columns in table order.
ARTIFACT_FLAGS = [
    "is_sbom", "is_signature", "is_attestation", "is_vex", "is_slsa_provenance",
    "is_in_toto_link", "is_in_toto_layout", "is_sigstore_bundle", "is_swid_tag",
    "is_container_attestation", "is_license_file",
]

# Format of a bill of materials, first hit wins.
SBOM_FORMATS: list[tuple[str, str]] = [
    ("spdx", "spdx"),
    ("cyclonedx", "cyclonedx OR cdx"),
    ("unknown", "sbom"),
]

# Workflow tools, in first-match order inside each category.
TOOL_RULES: list[ToolRule] = [
    ToolRule("sbom-generator", "syft", "syft"),
    ToolRule("sbom-generator", "trivy", "trivy"),
    ToolRule("sbom-generator", "cdxgen", "cdxgen"),
    ToolRule("sbom-generator", "spdx-sbom-generator", "spdx-sbom-generator"),
    ToolRule("sbom-generator", "tern", "tern"),
    ToolRule("signer", "cosign", "cosign"),
    ToolRule("signer", "sigstore", "sigstore"),
    ToolRule("signer", "slsa-github-generator", "slsa-github-generator"),
    ToolRule("signer", "notation", "notation OR notaryproject"),
    ToolRule("goreleaser", "goreleaser", "goreleaser-action"),
    ToolRule("vulnerability-scanner", "snyk", "snyk"),
    ToolRule("vulnerability-scanner", "anchore", "anchore"),
    ToolRule("vulnerability-scanner", "twistlock", "twistlock"),
    ToolRule("vulnerability-scanner", "aqua", "aqua"),
    ToolRule("vulnerability-scanner", "clair", "clair"),
    ToolRule("dependency-scanner", "dependabot", "dependabot"),
    ToolRule("dependency-scanner", "renovate", "renovate"),
    ToolRule("dependency-scanner", "whitesource", "whitesource"),
    ToolRule("dependency-scanner", "fossa", "fossa"),
    ToolRule("code-scanner", "codeql", "codeql"),
    ToolRule("code-scanner", "semgrep", "semgrep"),
    ToolRule("code-scanner", "bandit", "bandit"),
    ToolRule("code-scanner", "eslint-security", "eslint-security"),
    ToolRule("container-scanner", "docker-scout", "docker-scout"),
    ToolRule("container-scanner", "grype", "grype"),
    ToolRule("container-scanner", "trivy", "trivy"),
]

# Documented detections that are off unless asked for.
OPTIONAL_TOOL_RULES: list[ToolRule] = [
    ToolRule("sbom-generator", "bomber", "devops-kung-fu bomber OR bomber"),
    ToolRule("sbom-generator", "ort", "oss-review-toolkit OR ort-project"),
    ToolRule("signer", "witness", "testifysec witness OR witness"),
    ToolRule("signer", "kyverno", "kyverno"),
    ToolRule("license-scanner", "scancode", "scancode"),
    ToolRule("license-scanner", "licensee", "licensee"),
    ToolRule("policy", "opa", "open-policy-agent OR opa OR rego"),
]

# Named search patterns of the generator survey.
GENERATOR_PATTERNS: dict[str, str] = {
    "syft": "anchore/sbom-action OR syft",
    "trivy": "aquasecurity/trivy-action OR trivy",
    "cdxgen": "cdxgen OR cyclonedx-cli",
    "spdx-sbom-generator": "spdx-sbom-generator",
    "sbom-tool": "microsoft/sbom-tool OR sbom-tool",
    "grype": "anchore/scan-action OR grype",
    "bom": "kubernetes-sigs/bom",
}

# Searches of the publishing survey.
GENERATES_SBOM = "syft OR trivy OR cdxgen OR sbom-tool"
GENERATES_SBOM_WIDE = "syft OR trivy OR cdxgen OR sbom-tool OR spdx-sbom-generator"
UPLOADS_ARTIFACT = "upload-artifact OR upload-release-asset OR softprops/action-gh-release"
CREATES_RELEASE = "create-release OR gh release OR github-release"

# Verbatim step texts, first hit wins.
STEP_TEXTS = [
    "anchore/sbom-action", "syft", "aquasecurity/trivy-action", "trivy", "cdxgen",
    "spdx-sbom-generator", "microsoft/sbom-tool",
]
UPLOAD_TEXTS: dict[str, str] = {
    "has_upload_artifact": "upload-artifact",
    "has_upload_release": "upload-release-asset",
    "has_gh_release_action": "softprops/action-gh-release",
}

# Tools and categories that get a column of their own per repository.
SUMMARY_CATEGORIES = [
    "sbom-generator", "signer", "goreleaser", "vulnerability-scanner", "dependency-scanner",
    "code-scanner", "container-scanner",
]
SUMMARY_TOOLS = [
    "syft", "trivy", "cdxgen", "cosign", "sigstore", "slsa-github-generator", "snyk",
    "dependabot", "renovate", "codeql", "grype",
]
SCANNER_CATEGORIES = [
    "vulnerability-scanner", "dependency-scanner", "code-scanner", "container-scanner",
]


def categories(rules: list[ToolRule]) -> list[str]:
    return list(dict.fromkeys(r.category for r in rules))


def rule_table(spark: SparkSession) -> DataFrame:
    """The whole catalogue as a DataFrame, one row per rule."""
    rows = [("artifact", "keyword", flag, query, True) for flag, query in ARTIFACT_KEYWORDS.items()]
    rows += [
        ("artifact", "extension", flag, " OR ".join(exts), True)
        for flag, exts in ARTIFACT_EXTENSIONS.items()
    ]
    rows += [("workflow", r.category, r.tool, r.query, True) for r in TOOL_RULES]
    rows += [("workflow", r.category, r.tool, r.query, False) for r in OPTIONAL_TOOL_RULES]
    return spark.createDataFrame(
        rows, "subject string, kind string, label string, query string, enabled boolean"
    )
