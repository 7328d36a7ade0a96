"""Relations: staging, core and mart plans, and the pipeline that wires them."""
