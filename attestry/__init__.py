"""Supply-chain analytics as Spark DataFrame jobs.

Sub-packages: ``sources`` (readers and writers), ``functions`` (column helpers
and the rule catalogue), ``operators`` (DataFrame -> DataFrame steps), ``plans``
(models and saved analyses built from operators) and ``streaming``.
"""
