"""DataFrame-to-DataFrame operators.  None of them opens a session or runs a job."""
