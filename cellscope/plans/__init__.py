"""End-to-end plans: the batch area-hour job, the analysis session, the scoring pipelines."""
