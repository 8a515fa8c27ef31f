from .pipelines import histogram_stream, ingest_stream, processed_stream, raw_stream
from .progress import progress_log
