-- Projects of one maturity level with at least :min_audits security audits.
SELECT project_name, security_audit_count
FROM base_cncf_projects
WHERE security_audit_count >= :min_audits AND maturity = :maturity
