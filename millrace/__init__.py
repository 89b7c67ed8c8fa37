"""Millrace: text, trip, edit-stream and service-log jobs as Spark DataFrame transforms."""
