"""Job entry points: the reference's applications re-expressed as Spark
jobs over the library operators. Each has ``run(spark, cfg)`` (testable)
and ``main()`` (reads its configuration from the environment)."""
