"""Entity plans, marts, reports and the layer runs, composed from operators."""
