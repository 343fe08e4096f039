"""Job plans composed from operators: table specs, sync cycles, rolling windows."""
