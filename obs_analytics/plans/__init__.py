"""Plans: shared frames, fitted models, the whole-job runner and the
registered queries with their independent SQL."""
