-- Repositories by use of a signing tool, for those with at least :min_releases releases.
SELECT uses_signer, count(*) AS repos, sum(total_releases) AS releases
FROM agg_repo_summary
WHERE total_releases >= :min_releases
GROUP BY uses_signer
