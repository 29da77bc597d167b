from .job import Entity, Job, JobReport, edges_of, run_job, vertices_of

__all__ = ["Entity", "Job", "JobReport", "edges_of", "run_job", "vertices_of"]
