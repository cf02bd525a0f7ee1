"""End-to-end jobs: catalogue, phones, ledger."""
