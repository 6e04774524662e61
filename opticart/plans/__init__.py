"""Plan inspection: what the physical plans of the data products contain."""
