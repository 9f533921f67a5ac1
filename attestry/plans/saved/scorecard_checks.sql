-- Checks of an external scorecard feed by result; runs only where that feed was loaded.
SELECT check_name, result, count(*) AS repos
FROM base_scorecard_checks
GROUP BY check_name, result
