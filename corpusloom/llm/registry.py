"""What the entry point registers of this subpackage."""

from __future__ import annotations

from corpusloom.suite import Suite


def llm_suites() -> list[Suite]:
    import corpus_pipeline
    from corpusloom.llm.suite import suite

    pipeline = Suite()
    pipeline.queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        pipeline.oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return [suite, pipeline]
