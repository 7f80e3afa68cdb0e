"""The jobs: silver ingest, earnings fact, gold views."""
