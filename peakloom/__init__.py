"""peakloom: chromatin-accessibility analytics as Spark jobs."""
